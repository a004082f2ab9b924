"""Key resolution: surrogate ids, reject-split joins, folha fallback.

``Migration`` turns the two sources into the target tables of a load into an
empty store, lazily: every property is a DataFrame plan. Ids are dense ranks of
the business keys (``surrogate_keys``), so a re-run gives the same ids and the
DuckDB oracle can reproduce them with ``row_number() over (order by key)``.

Join plan (for 100 TB): payslip header, snapshot and line all join on the
4-part payslip key; ids are resolved once per payslip (``payslip_ids``) and
reused: a line joins the outcome map of the payslips once, which gives its id or the reason it has none.
Every join is left to the planner and AQE, which broadcast by real size.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrid.functions import normalize as N
from paygrid.operators import entities as E
from paygrid.operators.counts import Counts, rows
from paygrid.operators.dedupe import ORDER_COL, keep_last, surrogate_keys
from paygrid.operators.joins import first_error, reject_split
from paygrid.session import materialize

PAYSLIP_KEY = E.PAYSLIP_KEY

# Reject messages (fixed values).
MSG_VINCULO_SEM_SERVIDOR = "Servidor nao encontrado para o vinculo."
MSG_CC_SEM_VINCULO = "Vinculo nao encontrado para o contracheque."
MSG_CC_SEM_FOLHA = "Folha de referencia nao encontrada para o contracheque."
MSG_SNAP_SEM_VINCULO = "Vinculo nao encontrado para snapshot."
MSG_SNAP_SEM_CC = "Contracheque nao encontrado para snapshot."
MSG_ITEM_SEM_VINCULO = "Vinculo nao encontrado para item."
MSG_ITEM_SEM_CC = "Contracheque nao encontrado para item."
MSG_DEFAULT = "Erro nao informado"

ERROR_COLUMNS = ["entidade", "chave_origem", "mensagem_erro"]


def folha_maps(folha: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D4 lookups: (month, normalised description) -> id and month-with-one-run -> id.

    The description map keeps the last run per (month, description); a NULL
    description is a key like any other (matched null-safe).
    """
    by_desc = folha.select(
        F.col("mes_ano_folha").alias("fd_mes"),
        N.norm_folha_desc("descricao_folha").alias("fd_desc"),
        F.col("id_folha_referencia").alias("fd_id"),
        F.struct("mes_ano_folha", "num_folha").alias("_ord"),
    )
    # Last run (in run-key order) wins when two runs of a month share a description.
    by_desc = keep_last(by_desc, ["fd_mes", "fd_desc"], "_ord")
    by_month = (
        folha.groupBy(F.col("mes_ano_folha").alias("fm_mes"))
        .agg(F.count_distinct("id_folha_referencia").alias("_n"), F.min("id_folha_referencia").alias("fm_id"))
        .filter(F.col("_n") == 1)
        .drop("_n")
    )
    return by_desc, by_month


def map_folha(df: DataFrame, folha: DataFrame, month_col: str = "mes_ano",
              desc_col: str = "folha_descricao_origem") -> DataFrame:
    """Add ``id_folha_por_descricao``, ``id_folha_por_mes`` and ``id_folha_referencia``."""
    by_desc, by_month = folha_maps(folha)
    x = df.withColumn("_ndesc", N.norm_folha_desc(desc_col))
    x = x.join(by_desc, (x[month_col] == by_desc.fd_mes) & x["_ndesc"].eqNullSafe(by_desc.fd_desc), "left")
    x = x.join(by_month, x[month_col] == by_month.fm_mes, "left")
    return (
        x.withColumnRenamed("fd_id", "id_folha_por_descricao")
        .withColumnRenamed("fm_id", "id_folha_por_mes")
        .withColumn("id_folha_referencia", F.coalesce("id_folha_por_descricao", "id_folha_por_mes"))
        .drop("_ndesc", "fd_mes", "fd_desc", "fm_mes")
    )


def _with_period(df: DataFrame) -> DataFrame:
    """(ano, mes) of the payslip, the partition of its snapshot, lines and consolidation."""
    return df.withColumn("ano", F.year("mes_ano")).withColumn("mes", F.month("mes_ano"))


def _key_text(prefix_cols: list[str]) -> Column:
    return F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in prefix_cols])


# Pay codes (two bigints each) up to which their list is sent to every task: 64 MB of keys and ids.
BROADCAST_CODES = 4_000_000

# Fact tables that get ids after the stored maximum.
FACT_IDS = {"contracheque": "id_contracheque", "contracheque_snapshot_funcional": "id_snapshot",
            "contracheque_item": "id_contracheque_item", "contracheque_consolidado": "id_contracheque_consolidado"}

# Tables that a fresh load ranks in one job, and the key that orders each.
RANKED = {"folha_referencia": ["mes_ano_folha", "num_folha"], "servidor": ["numfunc"], "rubrica": ["codigo_rubrica"],
          "servidor_vinculo": ["numfunc", "numvinc"]}


class Migration:
    """All target tables of one load, as lazy DataFrames.

    ``checks`` / ``folhas_src`` are the raw sources (upper-case columns).
    ``load_ts`` stamps ``updated_at`` (a fixed value keeps results comparable).
    Counts are taken by the writes (``counts``); ``counted`` also writes the payroll runs to count them.
    """

    def __init__(self, checks: DataFrame, folhas_src: DataFrame, load_ts=None,
                 normalized: DataFrame | None = None, existing: dict[str, DataFrame] | None = None,
                 counts: Counts | None = None, counted: bool = False):
        self._checks = checks
        self._normalized = normalized
        self.counts = counts or Counts()
        self.nf = E.normalize_folhas(folhas_src)
        if counted:
            self.nf = materialize(self.counts.watch(folhas_lidas=rows())(self.nf), "folhas")
        self.load_ts = load_ts
        # Stored target tables: when present, each table is upserted into its stored
        # version (ids kept, new keys after the stored maximum) instead of built fresh.
        self.existing = existing or {}
        # Tables that were stored when the load began.
        self._stored = frozenset(self.existing)

    @cached_property
    def w(self) -> DataFrame:
        """The normalised wide source, written once (bronze) and shared by every entity."""
        if self._normalized is not None:
            return self._normalized
        return materialize(self.counts.watch(linhas_brutas=rows())(E.normalize_checks(self._checks)), "bronze")

    def _dim(self, table: str, src: DataFrame, keys: list[str], id_col: str,
             fact: bool = False) -> DataFrame:
        """An upsert into the stored table (A7/A11), or fresh ids in key order.

        For a fact table only the periods of this batch are read and returned
        (the store rewrites just those partitions); new ids continue after the
        maximum of the whole table.
        """
        from paygrid.operators.sinks import UPSERT_CONTRACTS, upsert

        old = self.existing.get(table)
        if old is None:
            return surrogate_keys(src, keys, id_col)
        _, upd = UPSERT_CONTRACTS[table]
        max_id = None
        if fact:
            max_id = self.max_ids[table]
            old = self.touched(old)
        src = src.select(*[c for c in src.columns if c in old.columns])
        return upsert(old, src, keys, [c for c in upd if c in old.columns], id_col=id_col, max_id=max_id)

    @cached_property
    def periods(self) -> list[tuple[int, int]]:
        """(ano, mes) of this batch's payslips: a short list (months), read to the driver."""
        found = _with_period(self.w.dropna(subset=PAYSLIP_KEY).select("mes_ano")).select("ano", "mes").distinct().collect()
        return sorted((int(r["ano"]), int(r["mes"])) for r in found)

    @cached_property
    def max_ids(self) -> dict[str, int]:
        """The largest id of every fact table that was stored when the load began, read by one job."""
        found = None
        for table in sorted(self._stored & FACT_IDS.keys()):
            top = self.existing[table].agg(F.max(FACT_IDS[table]).cast("bigint").alias("m")).select(F.lit(table).alias("t"), "m")
            found = top if found is None else found.unionByName(top)
        return {r["t"]: r["m"] or 0 for r in found.collect()} if found is not None else {}

    def touched(self, df: DataFrame) -> DataFrame:
        """Rows of the batch's periods; on a table partitioned by (ano, mes) this prunes partitions."""
        # One look-up in a set: a chain of comparisons is analysed and optimised again by every plan behind it.
        return df.filter((F.col("ano") * 100 + F.col("mes")).isin([a * 100 + m for a, m in self.periods]))

    def _ts(self) -> Column:
        if self.load_ts is None:
            return F.lit(None).cast("timestamp_ntz")
        return F.lit(self.load_ts).cast("timestamp_ntz")

    # -- entities ---------------------------------------------------------------
    @cached_property
    def servidor_src(self) -> DataFrame:
        return E.servidores(self.w)

    @cached_property
    def vinculo_src(self) -> DataFrame:
        return E.vinculos(self.w)

    @cached_property
    def rubrica_src(self) -> DataFrame:
        return E.rubricas(self.w)

    @cached_property
    def payslip_src(self) -> DataFrame:
        return E.payslips(self.w)

    @cached_property
    def item_src(self) -> DataFrame:
        # Lines are numbered by their source order inside the payslip; ids are assigned after resolution.
        return E.itens(self.w, with_order=True)

    @cached_property
    def folha_src(self) -> DataFrame:
        return E.folhas(self.nf)

    # -- dimensions with ids ----------------------------------------------------
    @cached_property
    def _ranked(self) -> DataFrame:
        """The rows of all dimensions that are not stored yet, ranked by one range exchange and one write.

        Rejected links are in it as well, ranked by themselves. A fresh link id follows the order of
        (employee, link), which is that of their source numbers.
        """
        known = self.servidor_src.select("numfunc", F.lit(True).alias("_known"))
        links = self.vinculo_src.join(known, "numfunc", "left").withColumn(
            "_erro", first_error((F.col("_known").isNull(), MSG_VINCULO_SEM_SERVIDOR))).drop("_known")
        frames = {"folha_referencia": self.folha_src.drop(ORDER_COL), "servidor": self.servidor_src,
                  "rubrica": self.rubrica_src, "servidor_vinculo": links}
        union = None
        for table, df in frames.items():
            if table in self._stored or (table == "servidor_vinculo" and not self._fresh_links):
                continue
            keys = [F.unix_date(k) if dict(df.dtypes)[k] == "date" else F.col(k) for k in RANKED[table]] + [F.lit(0)]
            bad = F.col("_erro").isNotNull() if "_erro" in df.columns else F.lit(False)
            part = df.select(F.lit(table).alias("_table"), bad.alias("_bad"),
                             *[k.cast("bigint").alias(f"_k{i}") for i, k in enumerate(keys[:2])], *df.columns)
            union = part if union is None else union.unionByName(part, allowMissingColumns=True)

        def n(table: str, bad: Column = F.lit(True)) -> Column:
            return F.count_if((F.col("_table") == table) & bad)

        watch = self.counts.watch(servidores_unicos=n("servidor"), vinculos_unicos=n("servidor_vinculo"),
                                  rubricas_unicas=n("rubrica"), erros_vinculo=n("servidor_vinculo", F.col("_bad")))
        return surrogate_keys(union, ["_table", "_bad", "_k0", "_k1"], "_id", within=["_table", "_bad"], watch=watch)

    @property
    def _fresh_links(self) -> bool:
        """Links are ranked with the dimensions when neither they nor the employees are stored."""
        return not {"servidor", "servidor_vinculo"} & self._stored

    def _fresh(self, table: str, id_col: str, columns: list[str]) -> DataFrame:
        return self._ranked.filter((F.col("_table") == table) & ~F.col("_bad")).select(F.col("_id").alias(id_col), *columns)

    @cached_property
    def folha(self) -> DataFrame:
        src = self.folha_src.drop(ORDER_COL)
        if "folha_referencia" not in self._stored:
            return self._fresh("folha_referencia", "id_folha_referencia", src.columns)
        return self._dim("folha_referencia", src, RANKED["folha_referencia"], "id_folha_referencia")

    @cached_property
    def servidor(self) -> DataFrame:
        if "servidor" not in self._stored:
            return self._fresh("servidor", "id_servidor", self.servidor_src.columns).withColumn("updated_at", self._ts())
        return self._dim("servidor", self.servidor_src.withColumn("updated_at", self._ts()), ["numfunc"], "id_servidor")

    @cached_property
    def rubrica(self) -> DataFrame:
        if "rubrica" not in self._stored:
            return self._fresh("rubrica", "id_rubrica", self.rubrica_src.columns).withColumn("updated_at", self._ts())
        return self._dim("rubrica", self.rubrica_src.withColumn("updated_at", self._ts()), ["codigo_rubrica"], "id_rubrica")

    # -- D2: vinculo -> servidor --------------------------------------------------
    @cached_property
    def vinculo_tagged(self) -> DataFrame:
        """Links with the first rule they fail; read from the ranked dimensions in a fresh load."""
        if self._fresh_links:
            return self._ranked.filter(F.col("_table") == "servidor_vinculo")
        x = self.vinculo_src.join(self.servidor.select("numfunc", "id_servidor"), "numfunc", "left")
        x = x.withColumn("_erro", first_error((F.col("id_servidor").isNull(), MSG_VINCULO_SEM_SERVIDOR)))
        return materialize(self.counts.watch(erros_vinculo=F.count_if(F.col("_erro").isNotNull()))(x), "vinculo")

    @cached_property
    def vinculo(self) -> DataFrame:
        """Links with ids (plus ``numfunc`` of their employee, used to resolve payslips)."""
        ids = self.servidor.select("id_servidor", "numfunc")
        if self._fresh_links:
            return self._fresh("servidor_vinculo", "id_vinculo", self.vinculo_src.columns).join(ids, "numfunc").withColumn(
                "updated_at", self._ts())
        ok, _ = reject_split(self.vinculo_tagged)
        v = self._dim("servidor_vinculo", ok.withColumn("updated_at", self._ts()).drop("numfunc"), ["id_servidor", "numvinc"],
                      "id_vinculo")
        return v.join(ids, "id_servidor", "left")

    @cached_property
    def vinculo_rejects(self) -> DataFrame:
        _, bad = reject_split(self.vinculo_tagged)
        return self._reject_rows(bad, "servidor_vinculo", _key_text(["numfunc", "numvinc"]), F.col("_erro"),
                                 self.vinculo_src.columns)

    @staticmethod
    def _reject_rows(bad: DataFrame, table: str, key: Column, message: Column, columns: list[str]) -> DataFrame:
        return bad.select(F.lit(table).alias("entidade"), key.alias("chave_origem"), message.alias("mensagem_erro"),
                          F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("payload_origem"))

    def _link_ids(self) -> DataFrame:
        return self.vinculo.select("numfunc", "numvinc", "id_servidor", "id_vinculo")

    # -- D3/D4/D5: payslip (header and snapshot) -> vinculo, folha ------------------
    @cached_property
    def payslips(self) -> DataFrame:
        """Every payslip of the batch with its links, the first rule it fails and, in a fresh load, its id.

        Header and snapshot of a payslip come from one source row and stand or fall together, so the
        snapshot needs no join of its own. Ranking and tagging share one write.
        """
        x = self.payslip_src.join(self._link_ids(), ["numfunc", "numvinc"], "left")
        x = map_folha(x, self.folha).withColumn("_erro", first_error(
            (F.col("id_vinculo").isNull(), MSG_CC_SEM_VINCULO),
            (F.col("id_folha_referencia").isNull(), MSG_CC_SEM_FOLHA),
        ))
        watch = self.counts.watch(contracheques_unicos=rows(), erros_contracheque=F.count_if(F.col("_erro").isNotNull()))
        if "contracheque" in self._stored:
            return materialize(watch(x), "payslips")
        # Fresh link ids are dense, so their ranges are known without a look at the payslips.
        last = self.counts["vinculos_unicos"] - self.counts["erros_vinculo"] if self._fresh_links else None
        x = surrogate_keys(x.withColumn("_bad", F.col("_erro").isNotNull()), ["_bad", "id_vinculo", "mes_ano", "numero"],
                           "_id", within=["_bad"], watch=watch, rebuilt={"hash_origem": E.hash_origem()},
                           dense=last and ("id_vinculo", last))
        return x.withColumn("id_contracheque", F.when(~F.col("_bad"), F.col("_id"))).drop("_bad", "_id")

    @cached_property
    def contracheque_tagged(self) -> DataFrame:
        return self.payslips

    CC_COLUMNS = ["id_contracheque", "id_vinculo", "id_folha_referencia", "mes_ano", "numero",
                  "folha_descricao_origem", "competencia", "bruto", "descontos", "liquido",
                  "data_consolidacao", "dt_lib_c_cheque", "ano", "mes", "hash_origem", "updated_at"]

    @cached_property
    def contracheque_ok(self) -> DataFrame:
        ok, _ = reject_split(self.payslips)
        return ok.withColumn("ano", F.col("ano").cast("int")).withColumn("mes", F.col("mes").cast("int")) \
            .withColumn("updated_at", self._ts())

    @cached_property
    def contracheque_full(self) -> DataFrame:
        """Accepted payslips of this batch with their id and business key (internal)."""
        ok = self.contracheque_ok
        if "id_contracheque" in ok.columns:
            return ok
        ids = self.contracheque.select("id_vinculo", "mes_ano", "numero", "id_contracheque")
        return ok.join(ids, ["id_vinculo", "mes_ano", "numero"], "inner")

    @cached_property
    def contracheque(self) -> DataFrame:
        if "contracheque" not in self._stored:
            return self.contracheque_full.select(*self.CC_COLUMNS)
        src = self.contracheque_ok.select(*[c for c in self.CC_COLUMNS if c != "id_contracheque"])
        return self._dim("contracheque", src, ["id_vinculo", "mes_ano", "numero"], "id_contracheque", fact=True)

    @cached_property
    def contracheque_rejects(self) -> DataFrame:
        _, bad = reject_split(self.payslips)
        return self._reject_rows(bad, "contracheque", _key_text(PAYSLIP_KEY), F.col("_erro"), [*PAYSLIP_KEY, *E.HEADER_COLUMNS])

    @cached_property
    def outcomes(self) -> DataFrame:
        """D3-D6 outcome map: every payslip key of the batch -> its id, or whether its link is missing."""
        x = self.payslips
        if "id_contracheque" not in x.columns:
            ids = self.contracheque.select("id_vinculo", "mes_ano", "numero", "id_contracheque")
            x = x.join(ids, ["id_vinculo", "mes_ano", "numero"], "left")
        return x.select(*PAYSLIP_KEY, "id_contracheque", F.col("id_vinculo").isNull().alias("_no_link"))

    # -- D5: snapshot ---------------------------------------------------------------
    @cached_property
    def snapshot(self) -> DataFrame:
        ok = self.contracheque_full.select("id_contracheque", *E.SNAPSHOT_COLUMNS, "ano", "mes")
        if "contracheque_snapshot_funcional" not in self._stored and "id_contracheque" in self.payslips.columns:
            # One snapshot per accepted payslip, in its order: the ids are those of the payslips.
            s = ok.withColumn("id_snapshot", F.col("id_contracheque"))
        else:
            s = self._dim("contracheque_snapshot_funcional", ok, ["id_contracheque"], "id_snapshot", fact=True)
        return s.select("id_snapshot", "id_contracheque", *E.SNAPSHOT_COLUMNS, "ano", "mes")

    @cached_property
    def snapshot_rejects(self) -> DataFrame:
        _, bad = reject_split(self.payslips)
        message = F.when(F.col("id_vinculo").isNull(), F.lit(MSG_SNAP_SEM_VINCULO)).otherwise(F.lit(MSG_SNAP_SEM_CC))
        return self._reject_rows(bad, "contracheque_snapshot_funcional", _key_text(PAYSLIP_KEY), message,
                                 [*PAYSLIP_KEY, *E.SNAPSHOT_COLUMNS])

    # -- D6/D7: item ------------------------------------------------------------------
    @cached_property
    def item_tagged(self) -> DataFrame:
        """Lines with payslip id, pay code id and the first rule they fail; with their own id in a fresh load."""
        x = self.item_src.join(self.outcomes, PAYSLIP_KEY, "left").withColumn("_erro", first_error(
            (F.col("_no_link"), MSG_ITEM_SEM_VINCULO),
            (F.col("id_contracheque").isNull(), MSG_ITEM_SEM_CC),
        )).drop("_no_link")
        x = _with_period(self._with_code_ids(x))
        watch = self.counts.watch(itens_processados=rows(), erros_item=F.count_if(F.col("_erro").isNotNull()),
                                  itens_inseridos=F.count_if(F.col("_erro").isNull()))
        if "contracheque_item" in self._stored:
            return materialize(watch(x), "items")
        # Accepted lines in the order of (payslip id, line number); rejected ones are ranked by themselves. The line
        # number stands for the source order, and what follows from other columns is not dealt out with them.
        x = x.drop(ORDER_COL).withColumn("_bad", F.col("_erro").isNotNull())
        total = N.item_total("valor_vantagem", "valor_auxiliar", "valor_desconto")
        last = self.counts["contracheques_unicos"] - self.counts["erros_contracheque"] if "contracheque" not in self._stored else None
        x = surrogate_keys(x, ["_bad", "id_contracheque", "sequencia_item"], "_id", within=["_bad"], watch=watch,
                           rebuilt={"item_hash": E.item_hash(), "valor_total_item": total,
                                    "ano": F.year("mes_ano"), "mes": F.month("mes_ano")},
                           dense=last and ("id_contracheque", last))
        return x.withColumn("id_contracheque_item", F.when(~F.col("_bad"), F.col("_id"))).drop("_bad", "_id")

    def _with_code_ids(self, lines: DataFrame) -> DataFrame:
        """Lines with the id of their pay code. A list of codes within ``BROADCAST_CODES`` is sent to the tasks."""
        codes = self.rubrica.select("codigo_rubrica", "id_rubrica")
        if "rubrica" not in self._stored and self.counts["rubricas_unicas"] <= BROADCAST_CODES:
            return lines.join(F.broadcast(codes), lines.codigo_rubrica_origem == codes.codigo_rubrica, "left").drop("codigo_rubrica")
        # Lines without a code match nothing; a key of their own spreads them, where NULL would send all to one task.
        codes = codes.select(F.col("codigo_rubrica").cast("string").alias("_code"), "id_rubrica")
        code = F.coalesce(F.col("codigo_rubrica_origem").cast("string"), F.concat(F.lit("~"), F.col("item_hash")))
        return lines.withColumn("_code", code).join(codes, "_code", "left").drop("_code")

    ITEM_COLUMNS = ["id_contracheque_item", "id_contracheque", "id_rubrica", "sequencia_item",
                    "codigo_rubrica_origem", "nome_rubrica_origem", "tipo_rubrica_origem", "complemento",
                    "info", "valor_vantagem", "valor_desconto", "valor_auxiliar", "valor_total_item",
                    "item_hash", "ano", "mes"]

    @cached_property
    def item(self) -> DataFrame:
        ok, _ = reject_split(self.item_tagged)
        old = self.existing.get("contracheque_item")
        if old is not None:
            return self._append_items(old, ok)
        # A payslip's lines are all accepted or all rejected, so its line numbers have no gaps.
        return ok.select(*self.ITEM_COLUMNS)

    def _append_items(self, old: DataFrame, batch: DataFrame) -> DataFrame:
        """Append only lines not stored yet; numbering continues after the stored maximum.

        A payslip's lines are one task's work, as where they are collapsed.
        """
        from paygrid.operators.sinks import append_if_absent

        old = self.touched(old)
        new = append_if_absent(old, batch)
        base = old.groupBy("id_contracheque").agg(F.max("sequencia_item").alias("_base"))
        order = Window.partitionBy("id_contracheque").orderBy(ORDER_COL, "item_hash")
        new = new.withColumn("_r", F.row_number().over(order)).join(base, "id_contracheque", "left").withColumn(
            "sequencia_item", (F.coalesce("_base", F.lit(0)) + F.col("_r")).cast("int")).drop("_base", "_r", ORDER_COL)
        counts = Counts()
        new = materialize(counts.watch(new=rows())(new), "new-items")
        new = surrogate_keys(new, ["id_contracheque", "sequencia_item"], "id_contracheque_item",
                             start=self.max_ids["contracheque_item"] + 1, rows=counts["new"])
        return old.select(*self.ITEM_COLUMNS).unionByName(new.select(*self.ITEM_COLUMNS))

    @cached_property
    def item_rejects(self) -> DataFrame:
        _, bad = reject_split(self.item_tagged)
        return self._reject_rows(bad, "contracheque_item", F.col("item_hash"), F.col("_erro"),
                                 [c for c in self.item_src.columns if c not in (ORDER_COL, "sequencia_item")])

    # -- H2/A14: reject log ---------------------------------------------------------
    def rejects(self, with_payload: bool = True) -> DataFrame:
        parts = [self.vinculo_rejects, self.contracheque_rejects, self.snapshot_rejects, self.item_rejects]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.withColumn("mensagem_erro", F.coalesce("mensagem_erro", F.lit(MSG_DEFAULT)))
        return out if with_payload else out.drop("payload_origem")


    def n_rejects(self) -> int:
        """Rejected rows, from the counts of the writes; a rejected payslip loses its header and its snapshot."""
        for prop in ("vinculo_tagged", "payslips", "item_tagged"):
            getattr(self, prop)
        return self.counts["erros_vinculo"] + 2 * self.counts["erros_contracheque"] + self.counts["erros_item"]


def _consolidado(m: Migration) -> DataFrame:
    """D8/E2 over every stored line of the batch's payslips, so any batch split converges."""
    from paygrid.operators import reconcile as R

    touched = m.contracheque_full
    items = m.item
    if "contracheque_item" in m.existing:
        items = items.join(touched.select("id_contracheque"), "id_contracheque", "left_semi")
    c = R.consolidate(touched, items, ["id_contracheque", "ano", "mes"])
    if "contracheque_consolidado" not in m.existing and "id_contracheque" in m.payslips.columns:
        # Fresh load: one row per accepted payslip and payslip ids are dense 1..n,
        # so the rank of id_contracheque is id_contracheque itself (no range shuffle).
        return c.withColumn("id_contracheque_consolidado", F.col("id_contracheque"))
    return m._dim("contracheque_consolidado", c, ["id_contracheque"], "id_contracheque_consolidado", fact=True)


Migration.consolidado = cached_property(_consolidado)
Migration.consolidado.__set_name__(Migration, "consolidado")
