"""Validation metrics and data-quality checks.

Every metric is an aggregate over the whole input (partial aggregation,
no driver-side accumulators). Defect frames hold every defect row; a caller that
shows examples asks for the first ``n``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.functions import normalize as N
from paygrid.operators.entities import PAYSLIP_KEY

FALLBACK_ALERT_PERCENT = 10    # fallback rate that raises the alert (fixed value)


# --- D4 twin for validation: mapping status per payslip ------------------------------

def mapping_status(contracheques: DataFrame, folhas: DataFrame) -> DataFrame:
    """Per payslip: DESCRICAO / FALLBACK / NAO_MAPEADO, using the run list only.

    ``folhas`` is the B2 frame: a payslip maps by (month, normalised description)
    when such a run exists, else by fallback when its month has exactly one run.
    """
    desc = folhas.select(F.col("mes_ano_folha").alias("fd_mes"),
                         N.norm_folha_desc("descricao_folha").alias("fd_desc")).distinct()
    months = folhas.groupBy(F.col("mes_ano_folha").alias("fm_mes")).agg(F.count(F.lit(1)).alias("fm_runs"))
    desc = desc.withColumn("_hit", F.lit(True))
    x = contracheques.withColumn("_ndesc", N.norm_folha_desc("folha_descricao_origem"))
    x = x.join(desc, (x.mes_ano == desc.fd_mes) & x._ndesc.eqNullSafe(desc.fd_desc), "left")
    x = x.join(months, x.mes_ano == months.fm_mes, "left")
    status = (F.when(F.col("_hit"), F.lit("DESCRICAO"))
              .when(F.col("fm_runs") == 1, F.lit("FALLBACK"))
              .otherwise(F.lit("NAO_MAPEADO")))
    return x.withColumn("forma_mapeamento", status).drop("_ndesc", "fd_mes", "fd_desc", "_hit", "fm_mes", "fm_runs")


def mapping_summary(status: DataFrame) -> DataFrame:
    """E6 + I17: totals by mapping kind and three percentages."""
    k = F.col("forma_mapeamento")
    agg = status.agg(
        F.count(F.lit(1)).alias("total_contracheques"),
        F.count_if(k == "DESCRICAO").alias("mapeados_por_descricao"),
        F.count_if(k == "FALLBACK").alias("mapeados_por_fallback"),
        F.count_if(k == "NAO_MAPEADO").alias("nao_mapeados"),
    )
    t = F.col("total_contracheques")
    return agg.select(
        "*",
        N.percent(F.col("mapeados_por_descricao") + F.col("mapeados_por_fallback"), t).alias("taxa_sucesso"),
        N.percent("mapeados_por_fallback", t).alias("taxa_fallback"),
        N.percent("nao_mapeados", t).alias("taxa_erro"),
    )


def mapping_failures(status: DataFrame, n: int | None = None) -> DataFrame:
    """Every unmapped payslip, or the first ``n`` in key order."""
    bad = status.filter(F.col("forma_mapeamento") == "NAO_MAPEADO").select(*PAYSLIP_KEY, "folha_descricao_origem")
    return bad if n is None else bad.orderBy(*PAYSLIP_KEY).limit(n)


# --- E4 / D16: distinct entities, payslips without a link -------------------------

def entity_counts(servidores: DataFrame, vinculos: DataFrame, rubricas: DataFrame,
                  contracheques: DataFrame) -> DataFrame:
    """Distinct employees, links, pay codes and payslips (one row).

    Each input is already one row per key, so the distinct count is a row count;
    the four counts are unioned and pivoted in one aggregate, no join.
    """
    parts = [
        servidores.select(F.lit("servidores_unicos").alias("k")),
        vinculos.select(F.lit("vinculos_unicos").alias("k")),
        rubricas.select(F.lit("rubricas_unicas").alias("k")),
        contracheques.select(F.lit("contracheques_unicos").alias("k")),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.count_if(F.col("k") == name).alias(name) for name in
                   ["servidores_unicos", "vinculos_unicos", "rubricas_unicas", "contracheques_unicos"]])


def sem_vinculo(contracheques: DataFrame, valid_links: DataFrame) -> DataFrame:
    """Payslips whose (numfunc, numvinc) is not a stored link (anti join)."""
    return contracheques.select(*PAYSLIP_KEY).join(
        valid_links.select("numfunc", "numvinc"), ["numfunc", "numvinc"], "left_anti")


# --- E9 / C8 / C9: pay codes ---------------------------------------------------------

def rubrica_quality(w: DataFrame, itens: DataFrame) -> DataFrame:
    """Distinct usable codes, lines with a NULL code, codes whose name is empty."""
    codes = w.filter(F.col("rubrica").isNotNull()).groupBy("rubrica").agg(
        F.count_if(F.col("nome_rubrica").isNotNull()).alias("_named"),
        F.count_if(F.col("nome_rubrica").isNull()).alias("_empty"))
    # Union the per-code flags with the per-line flags and sum once: no join.
    u = codes.select((F.col("_named") > 0).cast("long").alias("a"), (F.col("_empty") > 0).cast("long").alias("b"),
                     F.lit(0).cast("long").alias("c")).unionByName(
        itens.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                     F.col("codigo_rubrica_origem").isNull().cast("long").alias("c")))
    return u.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("rubricas_distintas"),
                 F.coalesce(F.sum("c"), F.lit(0)).alias("rubricas_nulas"),
                 F.coalesce(F.sum("b"), F.lit(0)).alias("nomes_rubrica_vazios"))


def rubrica_null_lines(itens: DataFrame, n: int | None = None) -> DataFrame:
    """Every line without a pay code, or the first ``n`` (key order, ties by content hash)."""
    bad = itens.filter(F.col("codigo_rubrica_origem").isNull())
    bad = bad if n is None else bad.orderBy(*PAYSLIP_KEY, "item_hash").limit(n)
    return bad.select(*PAYSLIP_KEY, "codigo_rubrica_origem", "nome_rubrica_origem")


# --- E7 / E8: distribution --------------------------------------------------------

def contracheques_por_mes(contracheques: DataFrame) -> DataFrame:
    """Payslips per month, sorted."""
    return contracheques.groupBy("mes_ano").agg(F.count(F.lit(1)).alias("quantidade")).orderBy("mes_ano")


def media_itens(itens: DataFrame) -> DataFrame:
    """Lines / payslips that have lines, 2 decimals (0 when there are none)."""
    a = itens.agg(F.count(F.lit(1)).alias("_n"),
                  F.count_distinct(*[F.col(c) for c in PAYSLIP_KEY]).alias("_k"))
    return a.select(F.when(F.col("_k") == 0, F.lit(Decimal("0.00")))
                    .otherwise(F.bround(F.col("_n").cast("decimal(38,10)") / F.col("_k"), 2))
                    .cast("decimal(12,2)").alias("media_itens_por_contracheque"))


# --- E10 / E11 / C7: payroll runs per month ---------------------------------------

def folha_months(folhas: DataFrame) -> DataFrame:
    """Per month: run count, sorted distinct run numbers, sorted distinct non-empty descriptions."""
    return folhas.groupBy(F.col("mes_ano_folha").alias("mes_ano")).agg(
        F.count(F.lit(1)).alias("quantidade_folhas"),
        F.array_sort(F.collect_set("num_folha")).alias("num_folhas"),
        F.array_sort(F.collect_set(N.norm_string("descricao_folha"))).alias("descricoes"),
    )


def folha_month_profile(folhas: DataFrame) -> DataFrame:
    """E10 summary: months, months with one run, months with several runs."""
    m = folha_months(folhas)
    return m.agg(F.count(F.lit(1)).alias("total_meses"),
                 F.count_if(F.col("quantidade_folhas") == 1).alias("meses_folha_unica"),
                 F.count_if(F.col("quantidade_folhas") > 1).alias("meses_multiplas_folhas"))


def folha_multi_months(folhas: DataFrame) -> DataFrame:
    """E10 detail (C7): months with more than one run."""
    return folha_months(folhas).filter(F.col("quantidade_folhas") > 1).orderBy("mes_ano")


def folhas_por_mes(folhas: DataFrame) -> DataFrame:
    """Runs per month."""
    return folhas.groupBy("mes_ano_folha").agg(F.count(F.lit(1)).alias("quantidade"))


# --- E16: dry run ------------------------------------------------------------------

def dry_run_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows of each entity frame; nothing is written."""
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("quantidade")).select(F.lit(name).alias("entidade"), "quantidade")
        out = part if out is None else out.unionByName(part)
    return out


# --- I22 / A15: alerts and the report as data ----------------------------------------

def validation_alerts(summary: DataFrame, rubrica_q: DataFrame) -> DataFrame:
    """Status flags from the mapping summary and pay-code quality (one row each side)."""
    n = F.lit(None)
    u = summary.select(F.col("nao_mapeados").cast("long").alias("nm"),
                       F.col("taxa_fallback").cast("decimal(7,2)").alias("tf"),
                       n.cast("long").alias("rn"), n.cast("long").alias("nv")).unionByName(
        rubrica_q.select(n.cast("long").alias("nm"), n.cast("decimal(7,2)").alias("tf"),
                         F.col("rubricas_nulas").cast("long").alias("rn"),
                         F.col("nomes_rubrica_vazios").cast("long").alias("nv")))
    x = u.agg(F.max("nm").alias("nm"), F.max("tf").alias("tf"), F.max("rn").alias("rn"), F.max("nv").alias("nv"))
    return x.select(
        (F.col("nm") == 0).alias("mapeamento_ok"),
        (F.col("tf") >= FALLBACK_ALERT_PERCENT).alias("fallback_alto"),
        ((F.col("rn") == 0) & (F.col("nv") == 0)).alias("rubricas_consistentes"),
    )


def long_metrics(section: str, one_row: DataFrame) -> DataFrame:
    """One-row metrics frame -> (secao, metrica, valor) rows with the value as text."""
    pairs = [F.struct(F.lit(c).alias("metrica"), F.col(c).cast("string").alias("valor")) for c in one_row.columns]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select(
        F.lit(section).alias("secao"), "m.metrica", "m.valor")


def validation_report(sections: dict[str, DataFrame], by_month: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every metric section as rows (secao, metrica, valor), ready for parquet/JSON.

    ``sections`` are one-row frames; ``by_month`` are (month, value) frames, one metric per month.
    """
    parts = [long_metrics(name, df) for name, df in sections.items()]
    for name, df in (by_month or {}).items():
        month, value = df.columns
        parts.append(df.select(F.lit(name).alias("secao"), F.date_format(month, "yyyy-MM").alias("metrica"),
                               F.col(value).cast("string").alias("valor")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
