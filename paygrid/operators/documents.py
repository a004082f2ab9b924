"""Per-payslip documents.

One distributed job replaces the reference's 1,000-row OFFSET/LIMIT pages:
candidates (payslip + link + employee, left folha + snapshot) -> greedy unique
run number per (employee, year, month) -> classified lines collected per payslip
-> nested struct -> JSON. Grouping is per payslip or per person-month; totals
are plain sums (map-side partial aggregation), only the document's own line
list is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrid.functions import normalize as N
from paygrid.session import materialize

FOLHA_NUMBER_BASE = 900000000   # first fallback run number (fixed value)

CANDIDATE_ORDER = ["numfunc", "ano", "mes", "num_folha", "numero"]


def scope_filter(df: DataFrame, year: int | None = None, month: int | None = None,
                 matricula: str | None = None, start_date=None, end_date=None) -> DataFrame:
    """ano = year [AND mes = month] [AND numfunc as text = matricula] [AND date range]."""
    if year is not None:
        df = df.filter(F.col("ano") == year)
    if month is not None:
        df = df.filter(F.col("mes") == month)
    if matricula is not None:
        df = df.filter(F.col("numfunc").cast("string") == F.lit(str(matricula)))
    if start_date is not None and end_date is not None:
        import datetime as dt
        df = df.filter((F.col("mes_ano") >= F.lit(start_date))
                       & (F.col("mes_ano") < F.lit(end_date + dt.timedelta(days=1))))
    return df


def candidates(contracheque: DataFrame, vinculo: DataFrame, servidor: DataFrame, folha: DataFrame,
               snapshot: DataFrame, **scope) -> DataFrame:
    """D12 + F4: one row per payslip with everything its document needs."""
    c = scope_filter(contracheque.select(
        "id_contracheque", "id_vinculo", "id_folha_referencia", "ano", "mes", "mes_ano", "competencia",
        "folha_descricao_origem", "dt_lib_c_cheque", "data_consolidacao", "numero"), **scope)
    sv = vinculo.select("id_vinculo", "id_servidor", "id_funcional",
                        F.col("regime_juridico").alias("vinc_regime_juridico"),
                        F.col("tipo_vinculo").alias("vinc_tipo_vinculo"))
    s = servidor.select("id_servidor", "numfunc", "nome", "cpf", "pis_pasep", "identidade")
    if scope.get("matricula") is not None:
        s = s.filter(F.col("numfunc").cast("string") == F.lit(str(scope["matricula"])))
    fr = folha.select("id_folha_referencia", "num_folha", "descricao_folha")
    csf = snapshot.select("id_contracheque", "orgao", "cargo", "ref_cargo", "funcao", "ref_funcao",
                          "municipio", "setor", F.col("regime_juridico").alias("snap_regime_juridico"),
                          F.col("tipo_vinculo").alias("snap_tipo_vinculo"), "banco", "agencia", "conta",
                          "carga_horaria")
    # Links meet their employees first, so that payslips are dealt out by link and by id only.
    links = sv.join(s, "id_servidor", "inner")
    x = (c.join(links, "id_vinculo", "inner")
         .join(fr, "id_folha_referencia", "left").join(csf, "id_contracheque", "left"))
    return first_per_key(x, "id_contracheque")


def pages(cands: DataFrame, size: int = 1_000) -> DataFrame:
    """G1: all pages of the candidates in id order: ``pagina, primeiro_id, ultimo_id, linhas``.

    Page bounds come from the distributed rank of the ids, one aggregate for all pages, without OFFSET; a page is
    then read by its bounds (``page``), so no page walks over the ones before it.
    """
    from paygrid.operators.dedupe import surrogate_keys

    ranked = surrogate_keys(cands.select("id_contracheque"), ["id_contracheque"], "_rank")
    return ranked.groupBy(F.floor((F.col("_rank") - 1) / size).alias("pagina")).agg(
        F.min("id_contracheque").alias("primeiro_id"), F.max("id_contracheque").alias("ultimo_id"),
        F.count(F.lit(1)).alias("linhas"))


def page(cands: DataFrame, first_id: int, last_id: int) -> DataFrame:
    """The candidates of one page by its bounds (a range filter that reaches the scan)."""
    return cands.filter(F.col("id_contracheque").between(first_id, last_id))


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """DISTINCT ON (key) ... ORDER BY numfunc, ano, mes, num_folha NULLS LAST, numero."""
    order = F.struct(F.col("numfunc"), F.col("ano"), F.col("mes"), F.col("num_folha").isNull(),
                     F.col("num_folha"), F.col("numero"))
    payload = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*payload), order).alias("_r"))
    return picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in payload])


def folha_numbers(cands: DataFrame) -> DataFrame:
    """unique run number (bigint) per (numfunc, ano, mes), greedy in (num_folha, numero, id) order.

    Each payslip takes the first of its num_folha / numero / id that is > 0 and
    not yet used in its person-month; else the first free number from
    max(900000000, id). The payslip id is a legal number, so the result is as wide as ids.
    A payslip alone in its person-month, the usual case, takes its first positive number
    without a fold; only groups of several are collected and folded with ``aggregate``.
    """
    me = ["numfunc", "ano", "mes"]
    slim = cands.select(*me, "num_folha", "numero", "id_contracheque")
    sizes = slim.groupBy(*[F.col(k).alias(f"_{k}") for k in me]).agg(F.count(F.lit(1)).alias("_n"))
    x = slim.join(sizes, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in me]).drop(*[f"_{k}" for k in me])
    pick = lambda c: F.when(F.col(c) > 0, F.col(c).cast("bigint"))
    alone = x.filter("_n = 1").select("id_contracheque", F.coalesce(
        pick("num_folha"), pick("numero"), pick("id_contracheque"),
        F.lit(FOLHA_NUMBER_BASE).cast("bigint")).alias("folha_numero"))
    rows = F.sort_array(F.collect_list(F.struct(
        F.col("num_folha").isNull().alias("n1"), F.col("num_folha").alias("v1"),
        F.col("numero").isNull().alias("n2"), F.col("numero").alias("v2"),
        F.col("id_contracheque").alias("id"))))
    g = x.filter("_n > 1").groupBy(*me).agg(rows.alias("rows"))
    fold = F.expr(f"""
      aggregate(rows, cast(array() as array<bigint>),
        (used, r) -> array_append(used, coalesce(
          get(filter(array(r.v1, r.v2, r.id), v -> v IS NOT NULL AND v > 0 AND NOT array_contains(used, v)), 0),
          get(filter(sequence(greatest({FOLHA_NUMBER_BASE}L, r.id), greatest({FOLHA_NUMBER_BASE}L, r.id) + size(used)),
                     v -> NOT array_contains(used, v)), 0))))""")
    z = g.select(F.explode(F.arrays_zip(F.col("rows.id").alias("id"), fold.alias("num"))).alias("p"))
    return alone.unionByName(z.select(F.col("p.id").alias("id_contracheque"), F.col("p.num").alias("folha_numero")))


def classified_items(items: DataFrame) -> DataFrame:
    """I12 + C5: lines with their document class; unclassified or non-positive lines dropped."""
    tipo, valor = N.item_class("valor_vantagem", "valor_auxiliar", "valor_desconto")
    x = items.select("id_contracheque", "id_contracheque_item", "sequencia_item", "codigo_rubrica_origem",
                     "nome_rubrica_origem", tipo.alias("tipo"), valor.alias("valor"))
    return x.filter(F.col("tipo").isNotNull() & (F.col("valor") > 0))


def document_totals(classified: DataFrame) -> DataFrame:
    """bruto = Σ VANTAGEM, descontos = Σ DESCONTO, liquido = bruto - descontos."""
    z = N.zero()
    x = classified.groupBy("id_contracheque").agg(
        F.coalesce(F.sum(F.when(F.col("tipo") == "VANTAGEM", F.col("valor"))), z).alias("bruto"),
        F.coalesce(F.sum(F.when(F.col("tipo") == "DESCONTO", F.col("valor"))), z).alias("descontos"),
        F.count(F.lit(1)).alias("total_rubricas"))
    return x.select("id_contracheque", F.col("bruto").cast(N.MONEY).alias("bruto"),
                    F.col("descontos").cast(N.MONEY).alias("descontos"),
                    (F.col("bruto") - F.col("descontos")).cast(N.MONEY).alias("liquido"), "total_rubricas")


def document_bodies(classified: DataFrame) -> DataFrame:
    """E14 + E15 in one aggregate: totals and the ordered list of line objects per payslip.

    Lines go by sequencia_item (NULLS LAST), then id. The list is the document itself, so one payslip's
    lines meet in one task by definition of the output.
    """
    line = F.struct(
        F.col("sequencia_item").isNull().alias("o1"), F.col("sequencia_item").alias("o2"),
        F.col("id_contracheque_item").alias("o3"),
        F.coalesce(F.col("codigo_rubrica_origem"), F.lit(0)).cast("bigint").alias("codigo"),
        F.coalesce(N.norm_string("nome_rubrica_origem"), F.lit("")).alias("descricao"),
        F.col("tipo").alias("tipo"),
        F.col("valor").cast("double").alias("valor"))
    z = N.zero()
    g = classified.groupBy("id_contracheque").agg(
        F.coalesce(F.sum(F.when(F.col("tipo") == "VANTAGEM", F.col("valor"))), z).alias("bruto"),
        F.coalesce(F.sum(F.when(F.col("tipo") == "DESCONTO", F.col("valor"))), z).alias("descontos"),
        F.sort_array(F.collect_list(line)).alias("_l"))
    return g.select("id_contracheque", F.col("bruto").cast(N.MONEY).alias("bruto"), F.col("descontos").cast(N.MONEY).alias("descontos"),
                    F.transform("_l", lambda e: F.struct(
                        e["codigo"].alias("codigo"), e["descricao"].alias("descricao"), e["tipo"].alias("tipo"),
                        e["valor"].alias("valor"))).alias("rubricas"))


def _txt(c: str) -> Column:
    return F.coalesce(N.norm_string(c), F.lit(""))


def payloads(cands: DataFrame, items: DataFrame) -> DataFrame:
    """B9 + I14-I16 + I18 + I21: the cache rows with the nested document."""
    # Written once: the semi join, the numbering and the document read the candidates.
    cands = materialize(cands, "candidates")
    classified = classified_items(items.join(cands.select("id_contracheque"), "id_contracheque", "left_semi"))
    x = (cands.join(folha_numbers(cands), "id_contracheque", "inner")
         .join(document_bodies(classified), "id_contracheque", "left"))
    z = N.zero()
    # The description and its token are columns: each is made once a payslip, however many fields read it.
    folha_desc, tipo = F.col("_folha_desc"), N.token_tipo("_folha_token")
    x = x.withColumn("_folha_desc", F.coalesce(N.norm_string("descricao_folha"), N.norm_string("folha_descricao_origem"), F.lit("")))
    x = x.withColumn("_folha_token", N.norm_token("_folha_desc"))
    comp_desc = F.coalesce(N.norm_string("folha_descricao_origem"), N.norm_string("competencia"),
                           F.format_string("%02d/%d", F.col("mes"), F.col("ano")))
    bruto = F.coalesce("bruto", z)
    descontos = F.coalesce("descontos", z)
    servidor = F.struct(
        _txt("nome").alias("nome"), _txt("cpf").alias("cpf"), F.col("numfunc").cast("string").alias("matricula"),
        _txt("id_funcional").alias("id_funcional"), _txt("orgao").alias("orgao"), _txt("cargo").alias("cargo"),
        _txt("ref_cargo").alias("referencia_cargo"), _txt("funcao").alias("funcao"),
        _txt("ref_funcao").alias("referencia_funcao"), _txt("municipio").alias("municipio"),
        _txt("setor").alias("setor"),
        F.coalesce(N.norm_string("snap_regime_juridico"), N.norm_string("vinc_regime_juridico"), F.lit(""))
        .alias("regime_juridico"),
        F.coalesce(N.norm_string("snap_tipo_vinculo"), N.norm_string("vinc_tipo_vinculo"), F.lit(""))
        .alias("tipo_vinculo"),
        _txt("banco").alias("banco"), _txt("agencia").alias("agencia"), _txt("conta").alias("conta"),
        _txt("pis_pasep").alias("pis_pasep"), _txt("identidade").alias("identidade"),
        N.decimal_or_zero("carga_horaria").cast("double").alias("carga_horaria"))
    competencia = F.struct(
        F.col("ano").cast("int").alias("ano"), F.col("mes").cast("int").alias("mes"),
        comp_desc.alias("descricao"), N.iso_date_or_empty("dt_lib_c_cheque").alias("data_liberacao"),
        F.col("folha_numero").alias("folha_numero"), tipo.alias("folha_tipo"),
        folha_desc.alias("folha_descricao"))
    resumo = F.struct(bruto.cast("double").alias("bruto"), descontos.cast("double").alias("descontos"),
                      (bruto - descontos).cast("double").alias("liquido"))
    empty_lines = F.array().cast("array<struct<codigo:bigint,descricao:string,tipo:string,valor:double>>")
    doc = F.struct(servidor.alias("servidor"), competencia.alias("competencia"), resumo.alias("resumo"),
                   F.coalesce("rubricas", empty_lines).alias("rubricas"))
    return x.select(
        "id_contracheque",
        F.col("numfunc").cast("string").alias("matricula"),
        _txt("cpf").alias("cpf"),
        F.col("ano").cast("int").alias("ano"), F.col("mes").cast("int").alias("mes"),
        "folha_numero",
        tipo.alias("folha_tipo"),
        F.coalesce(N.norm_folha_desc(folha_desc), folha_desc).alias("folha_descricao"),
        doc.alias("contracheque"),
    )


def to_cache_rows(p: DataFrame, updated_at=None) -> DataFrame:
    """Cache table rows: the document serialised as JSON text (NULL fields kept)."""
    ts = F.lit(updated_at).cast("timestamp_ntz") if updated_at is not None else F.lit(None).cast("timestamp_ntz")
    return p.select("matricula", "cpf", "ano", "mes", "folha_numero", "folha_tipo", "folha_descricao",
                    F.to_json("contracheque", {"ignoreNullFields": "false"}).alias("contracheque_json"),
                    ts.alias("updated_at"))
