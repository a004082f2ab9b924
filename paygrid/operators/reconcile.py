"""Reconciliation: payslip header versus its lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.functions.normalize import MONEY, zero


def item_totals(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per payslip Σvantagem, Σauxiliar, Σdesconto (NULL-only -> 0.00) and line count.

    A plain aggregate: partial sums are combined map-side, so a payslip with a
    huge number of lines never reaches one task as rows.
    """
    z = zero()
    return items.groupBy(*keys).agg(
        F.coalesce(F.sum("valor_vantagem"), z).cast(MONEY).alias("soma_vantagem"),
        F.coalesce(F.sum("valor_auxiliar"), z).cast(MONEY).alias("soma_auxiliar"),
        F.coalesce(F.sum("valor_desconto"), z).cast(MONEY).alias("soma_desconto"),
        F.count(F.lit(1)).cast("int").alias("total_itens"),
    )


def consolidate(headers: DataFrame, items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D8 + E2: every header left-joined to its line totals, with the three divergences."""
    z = zero()
    totals = item_totals(items, keys)
    x = headers.select(*keys, "bruto", "descontos", "liquido").join(totals, list(keys), "left")
    tv = (F.coalesce("soma_vantagem", z) + F.coalesce("soma_auxiliar", z)).cast(MONEY)
    td = F.coalesce("soma_desconto", z).cast(MONEY)
    return x.select(
        *keys,
        tv.alias("total_vantagens"),
        td.alias("total_descontos_itens"),
        F.coalesce("total_itens", F.lit(0)).cast("int").alias("total_itens"),
        (F.coalesce("bruto", z) - tv).cast(MONEY).alias("divergencia_bruto"),
        (F.coalesce("descontos", z) - td).cast(MONEY).alias("divergencia_descontos"),
        (F.coalesce("liquido", z) - (tv - td)).cast(MONEY).alias("divergencia_liquido"),
    )


def is_divergent() -> F.Column:
    """Any of the three divergences differs from 0.00."""
    return (F.col("divergencia_bruto") != 0) | (F.col("divergencia_descontos") != 0) | (
        F.col("divergencia_liquido") != 0)


def divergent(consolidated: DataFrame) -> DataFrame:
    return consolidated.filter(is_divergent())


def reconcile_source(w: DataFrame) -> DataFrame:
    """Single-scan D8/E2 straight from the normalised wide source.

    Same result as ``consolidate(contracheques(w), itens(w), PAYSLIP_KEY)`` with
    one scan of the source instead of two: lines are deduplicated by content hash
    carrying the header fields, then one per-payslip aggregate sums the lines and
    picks the header of the last source row with ``max_by``. The last row of a
    payslip always survives the dedupe (it is the last of its own hash group),
    and every payslip has at least one line, so nothing is lost.
    """
    from paygrid.operators.dedupe import keep_last
    from paygrid.operators.entities import PAYSLIP_KEY

    z = zero()
    x = w.dropna(subset=PAYSLIP_KEY).select(
        *PAYSLIP_KEY, "bruto", "descontos", "liquido", "src_order",
        F.col("vantagem").alias("valor_vantagem"), F.col("desconto").alias("valor_desconto"),
        F.col("auxiliar").alias("valor_auxiliar"),
        stable_hash_item(F.col("rubrica"), F.col("complemento"), F.col("info"),
                         F.col("vantagem"), F.col("desconto"), F.col("auxiliar")).alias("item_hash"))
    lines = keep_last(x, ["item_hash"], "src_order", keep_order=True)
    g = lines.groupBy(*PAYSLIP_KEY).agg(
        F.coalesce(F.sum("valor_vantagem"), z).alias("sv"), F.coalesce(F.sum("valor_auxiliar"), z).alias("sa"),
        F.coalesce(F.sum("valor_desconto"), z).alias("sd"), F.count(F.lit(1)).alias("n"),
        F.max_by(F.struct("bruto", "descontos", "liquido"), F.col("src_order")).alias("h"))
    tv = (F.col("sv") + F.col("sa")).cast(MONEY)
    td = F.col("sd").cast(MONEY)
    return g.select(
        *PAYSLIP_KEY, tv.alias("total_vantagens"), td.alias("total_descontos_itens"),
        F.col("n").cast("int").alias("total_itens"),
        (F.coalesce("h.bruto", z) - tv).cast(MONEY).alias("divergencia_bruto"),
        (F.coalesce("h.descontos", z) - td).cast(MONEY).alias("divergencia_descontos"),
        (F.coalesce("h.liquido", z) - (tv - td)).cast(MONEY).alias("divergencia_liquido"))


def stable_hash_item(rubrica, complemento, info, vantagem, desconto, auxiliar) -> F.Column:
    """I8b over the source columns (the same hash ``entities.itens`` computes)."""
    from paygrid.functions.normalize import stable_hash

    z = zero()
    return stable_hash("numfunc", "numvinc", "mes_ano", "numero", rubrica, complemento, info,
                       F.coalesce(vantagem, z), F.coalesce(desconto, z), F.coalesce(auxiliar, z))
