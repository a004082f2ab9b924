"""Idempotent load operators.

``upsert`` is INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols =
excluded.* expressed as a full outer join: updated columns take the incoming
value even when it is NULL, other columns (surrogate id, created_at) keep the
stored value, new keys get new ids after the stored maximum. The result is a
new version of the table: write it to a new path (or a table format with
MERGE); never overwrite the path it was read from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrid.operators.counts import Counts
from paygrid.operators.dedupe import surrogate_keys
from paygrid.session import materialize

STATUS_OK = "SUCESSO"
STATUS_PARTIAL = "SUCESSO_PARCIAL"
STATUS_ERROR = "ERRO"
STATUS_STARTED = "INICIADO"

# Upsert contracts of the target model: conflict key and updated columns (fixed values).
UPSERT_CONTRACTS = {
    "folha_referencia": (["mes_ano_folha", "num_folha"],
                         ["descricao_folha", "data_consolidacao", "dt_lib_c_cheque", "ano", "mes", "ativa"]),
    "servidor": (["numfunc"], ["cpf", "nome", "pis_pasep", "identidade", "updated_at"]),
    "servidor_vinculo": (["id_servidor", "numvinc"],
                         ["id_funcional", "regime_juridico", "tipo_vinculo", "ativo", "updated_at"]),
    "rubrica": (["codigo_rubrica"], ["nome_rubrica", "tipo_rubrica", "ativa", "updated_at"]),
    "contracheque": (["id_vinculo", "mes_ano", "numero"],
                     ["id_folha_referencia", "folha_descricao_origem", "competencia", "bruto", "descontos",
                      "liquido", "data_consolidacao", "dt_lib_c_cheque", "ano", "mes", "hash_origem",
                      "updated_at"]),
    "contracheque_snapshot_funcional": (["id_contracheque"],
                                        ["orgao", "cargo", "ref_cargo", "funcao", "ref_funcao", "municipio",
                                         "setor", "regime_juridico", "tipo_vinculo", "banco", "agencia",
                                         "conta", "carga_horaria"]),
    "contracheque_consolidado": (["id_contracheque"],
                                 ["total_vantagens", "total_descontos_itens", "total_itens",
                                  "divergencia_bruto", "divergencia_descontos", "divergencia_liquido"]),
    "contracheque_cache": (["matricula", "ano", "mes", "folha_numero"],
                           ["cpf", "folha_tipo", "folha_descricao", "contracheque_json", "updated_at"]),
}


class DuplicateKeyError(ValueError):
    """The incoming batch has the same conflict key twice (PostgreSQL would refuse it)."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a non-NULL key appears twice (reads at most one offending key)."""
    dup = df.dropna(subset=list(keys)).groupBy(*keys).count().filter(F.col("count") > 1).limit(1)
    if dup.count():
        raise DuplicateKeyError(f"duplicate conflict key in upsert input: {keys}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           id_col: str | None = None, check_unique: bool = True, max_id: int | None = None) -> DataFrame:
    """The target after INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols.

    Key columns compare with ``=`` so a NULL key never conflicts. Empty input is
    a no-op. ``id_col`` (surrogate key) is kept for existing keys and assigned
    ``max(id) + 1, ...`` in key order for new ones; pass ``max_id`` when
    ``target`` is only the touched partitions of a larger table. With ``id_col`` the join is written, and repeated keys,
    new rows and the stored maximum are counted by that write; else a job of its own looks for repeated keys.
    """
    if check_unique and id_col is None:
        assert_unique(source, keys)
    cols = target.columns
    t = target.withColumn("_t", F.lit(True))
    s = source.select(*[c for c in source.columns if c in cols]).withColumn("_s", F.lit(True))
    # The window deals out and sorts the rows as the join does.
    s = s.withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy(*keys)) if check_unique and id_col else F.lit(1))
    cond = [t[k] == s[k] for k in keys]
    j = t.alias("t").join(s.alias("s"), cond, "full_outer")
    out = []
    for c in cols:
        tc, sc = F.col(f"t.{c}"), (F.col(f"s.{c}") if c in s.columns else F.lit(None))
        if c in keys:
            out.append(F.when(F.col("t._t").isNotNull(), tc).otherwise(sc).alias(c))
        elif c in update_cols:
            out.append(F.when(F.col("s._s").isNotNull(), sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(F.col("t._t").isNotNull(), tc).otherwise(sc).alias(c))
    if id_col is None:
        return j.select(*out)
    merged = j.select(*out, F.col("t._t").isNotNull().alias("_existing"), F.col("s._times").alias("_times"))
    repeated = F.col("_times") > 1
    for k in keys:
        repeated = repeated & F.col(k).isNotNull()
    counts = Counts()
    watch = counts.watch(repeated=F.count_if(repeated), new=F.count_if(~F.col("_existing")),
                         max_id=F.max(F.when(F.col("_existing"), F.col(id_col))))
    # Written once: the stored and the new rows below are two readers of the join.
    merged = materialize(watch(merged).drop("_times"), "upsert")
    if counts["repeated"]:
        raise DuplicateKeyError(f"duplicate conflict key in upsert input: {keys}")
    kept = merged.filter("_existing").drop("_existing")
    if not counts["new"]:
        return kept
    new = merged.filter(~F.col("_existing")).drop("_existing", id_col)
    # The next free id is one number: the new keys are ranked after it.
    new = surrogate_keys(new, list(keys), id_col, start=(counts["max_id"] if max_id is None else max_id) + 1, rows=counts["new"])
    return kept.unionByName(new.select(*cols))


def content_hash(df: DataFrame) -> Column:
    """Stored-line hash over the payslip id and six content fields (NULL money as 0.00)."""
    from paygrid.functions import normalize as N

    z = N.zero()
    return N.stable_hash("id_contracheque", "codigo_rubrica_origem", "complemento", "info",
                         F.coalesce("valor_vantagem", z), F.coalesce("valor_desconto", z),
                         F.coalesce("valor_auxiliar", z), texts=("complemento", "info"))


def append_if_absent(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """A8 + D9 + H4: incoming lines whose content is not yet stored for their payslip.

    Anti join on (payslip id, content hash); only the stored lines of payslips in
    the batch are hashed (semi join first), like the reference's lookup.
    """
    inc = incoming.withColumn("_h", content_hash(incoming))
    touched = stored.join(incoming.select("id_contracheque").distinct(), "id_contracheque", "left_semi")
    have = touched.select("id_contracheque", content_hash(touched).alias("_h"))
    return inc.join(have, ["id_contracheque", "_h"], "left_anti").drop("_h")


def scope_predicate(year: int, month: int | None = None, matricula: str | None = None) -> Column:
    """C4: year / year+month / year+month+matricula; matricula needs a month."""
    if matricula is not None and month is None:
        raise ValueError("matricula requires a month")
    pred = F.col("ano") == year
    if month is not None:
        pred = pred & (F.col("mes") == month)
    if matricula is not None:
        pred = pred & (F.col("matricula") == F.lit(str(matricula)))
    return pred


def scoped_delete(cache: DataFrame, year: int, month: int | None = None,
                  matricula: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(remaining rows, one-row count of removed rows)."""
    pred = scope_predicate(year, month, matricula)
    remaining = cache.filter(~pred)
    removed = cache.agg(F.count_if(pred).alias("removidos"))
    return remaining, removed


def cache_upsert_counts(existing: DataFrame, rows: DataFrame,
                        keys: Sequence[str] = ("matricula", "ano", "mes", "folha_numero")) -> DataFrame:
    """A10 + D10: processed / inserted / updated counts of a cache upsert (one row)."""
    flag = rows.select(*keys).join(existing.select(*keys).distinct().withColumn("_hit", F.lit(1)), list(keys), "left")
    return flag.agg(F.count(F.lit(1)).alias("processados"),
                    F.count_if(F.col("_hit").isNull()).alias("inseridos"),
                    F.count_if(F.col("_hit").isNotNull()).alias("atualizados"))


def counts_row(parts: dict[str, DataFrame]) -> DataFrame:
    """Several row counts side by side in one row (union + one aggregate, no joins)."""
    u = None
    for name, df in parts.items():
        p = df.select(F.lit(name).alias("_k"))
        u = p if u is None else u.unionByName(p)
    return u.agg(*[F.count_if(F.col("_k") == name).alias(name) for name in parts])


def load_audit(counts: DataFrame, tipo_origem: str = "ORACLE", referencia: str | None = None,
               observacao: str | None = None) -> DataFrame:
    """A12/A13 + E12: the audit row of a finished load from its counts.

    ``counts`` has folhas_lidas, linhas_brutas, contracheques_unicos, itens_processados, erros.
    """
    err = F.col("erros")
    return counts.select(
        F.lit(tipo_origem).alias("tipo_origem"), F.lit(referencia).cast("string").alias("referencia"),
        F.when(err > 0, F.lit(STATUS_PARTIAL)).otherwise(F.lit(STATUS_OK)).alias("status"),
        (F.col("folhas_lidas") + F.col("linhas_brutas")).alias("qtd_registros_lidos"),
        (F.col("contracheques_unicos") + F.col("itens_processados")).alias("qtd_registros_processados"),
        err.alias("qtd_registros_erro"),
        F.lit(observacao).cast("string").alias("observacao"))


def error_rows(rejects: DataFrame, id_carga: int | Column) -> DataFrame:
    """Rows of carga_importacao_erro for one load (message defaulted)."""
    idc = id_carga if isinstance(id_carga, Column) else F.lit(id_carga)
    return rejects.select(idc.cast("bigint").alias("id_carga"), "chave_origem",
                          F.coalesce("mensagem_erro", F.lit("Erro nao informado")).alias("mensagem_erro"),
                          "payload_origem")


def merge_rows(frames: list[DataFrame]) -> DataFrame:
    """One-row frames of bigint metrics side by side (long union + one pivot aggregate, no join)."""
    names: list[str] = []
    u = None
    for df in frames:
        names += df.columns
        pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("bigint").alias("v")) for c in df.columns])
        part = df.select(F.explode(pairs).alias("p")).select("p.k", "p.v")
        u = part if u is None else u.unionByName(part)
    return u.agg(*[F.max(F.when(F.col("k") == n, F.col("v"))).alias(n) for n in names])
