"""Window-like operators: keep-last per key (F1), line numbers (F2), surrogate keys.

All three are written so that no single key, however hot, lands whole in one
task or on the driver:

* ``keep_last`` is an aggregate (``max_by`` over the order struct), so every map
  task pre-aggregates before the shuffle and a hot key arrives as one partial
  row per input partition.
* ``surrogate_keys`` ranks a range-partitioned frame: per-partition row counts
  (one row per partition, a proven size bound) are broadcast as offsets; there
  is no single-partition global window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrid.session import materialize

ORDER_COL = "src_order"


def keep_last(df: DataFrame, keys: Sequence[str], order: str | Column = ORDER_COL,
              keep_order: bool = False) -> DataFrame:
    """Keep, for every key, the whole row that is last by ``order``.

    Map-side partial aggregation makes this skew-safe. Rows with a NULL key form
    their own group (callers drop NULL-required rows first, as the source does).
    """
    order_col = F.col(order) if isinstance(order, str) else order
    payload = [c for c in df.columns if c not in keys]
    if isinstance(order, str) and keep_order and order not in payload:
        payload.append(order)
    if not payload:
        return df.select(*keys).distinct()
    # The order column already holds every field that decides; carried once, it is also the row's order.
    rest = [c for c in payload if c != order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(order_col.alias("_order"), *rest)).alias("_row"))
    out = picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest],
                        *([F.col("_row._order").alias(order)] if isinstance(order, str) and order in payload else []))
    if isinstance(order, str) and not keep_order and order in out.columns:
        out = out.drop(order)
    return out.select(*[c for c in [*keys, *payload] if c in out.columns])


def sequence_in_group(df: DataFrame, keys: Sequence[str], order: str = ORDER_COL,
                      name: str = "sequencia_item") -> DataFrame:
    """1-based line number inside each group in ``order``, without a per-group task.

    The line number is the global rank over (keys, order) minus the rank of the
    group's first row. The global rank range-partitions on the composite key,
    so one group holding a third of all rows is split over many partitions; the
    group starts are a partial aggregate and the join back is one where AQE
    splits a skewed partition. ``order`` must make (keys, order) unique.
    """
    ranked = surrogate_keys(df, [*keys, order], "_g")
    starts = ranked.groupBy(*keys).agg(F.min("_g").alias("_g0"))
    out = ranked.join(starts, list(keys), "inner")
    return out.withColumn(name, (F.col("_g") - F.col("_g0") + 1).cast("int")).drop("_g", "_g0")


def surrogate_keys(df: DataFrame, order_cols: Sequence[str], id_col: str, start: int | Column = 1,
                   num_partitions: int | None = None, within: Sequence[str] = (),
                   watch: Callable[[DataFrame], DataFrame] | None = None,
                   rebuilt: Mapping[str, Column] | None = None, dense: tuple[str, int] | None = None,
                   rows: int | None = None) -> DataFrame:
    """dense ids ``start, start+1, ...`` in the order of ``order_cols``.

    ``order_cols`` must be unique in ``df`` (a business key). The frame is
    range-partitioned on the key, sorted inside each partition, numbered with
    ``monotonically_increasing_id`` (partition index in the high bits, position
    in the low bits) and shifted by the number of rows in earlier partitions.
    Same ids as ``row_number() over (order by key)``, without the single task.

    ``within`` names leading ``order_cols`` of few distinct values: ids start anew for each of them, so several
    tables, or accepted and rejected rows, are ranked and written by one job. ``watch`` is applied to the frame that
    is written, to count rows while they are written. ``rebuilt`` maps columns that follow from the others to their
    expressions: they are left out of the exchange and of the write and made again by the readers that want them.

    ``dense`` names the order column after ``within`` and its largest value ``n`` when that column holds ids of 1..n
    (NULL or not in rows whose ids nobody reads): equal ranges of it are dealt out as they are. Without it the range bounds
    are sampled, and sampling runs everything behind ``df`` once more. Rows of one value meet in one task then.

    ``rows`` is the number of rows of a written ``df``, where the caller knows it: up to ``FEW_ROWS`` are numbered by a
    window in one task, which is cheaper than sampled ranges and a write, and as bounded.

    The numbered frame is written (parquet, under the shared checkpoint folder)
    and read back: range bounds come from sampling, so the counts and the
    positions must come from the very same partitioning; two independent
    exchanges may sample different bounds. Once written, partition index and
    position are plain columns. This also cuts the lineage, leaves nothing in
    the cache, and a lost executor re-reads files instead of re-sampling.
    """
    if list(within) != list(order_cols)[:len(within)]:
        raise ValueError("within must be the first order columns")
    columns = df.columns
    if rows is not None and rows <= FEW_ROWS and not (within or watch or rebuilt):
        rank = F.row_number().over(Window.orderBy(*order_cols))
        return df.withColumn(id_col, (rank - 1 + start).cast("bigint")).select(*[c for c in columns if c != id_col], id_col)
    df = df.drop(*(rebuilt or {}))
    if dense and num_partitions is None:
        ranged = df.repartitionById(*_ranges(df, order_cols, *dense)).sortWithinPartitions(*order_cols)
    else:
        # Without an explicit count AQE may coalesce neighbouring ranges; coalesced
        # partitions are still contiguous key ranges in index order.
        ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
                  else df.repartitionByRange(*order_cols)).sortWithinPartitions(*order_cols)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("_mid")
    tagged = materialize(watch(tagged) if watch else tagged, "ids")
    # One row per partition and group: rows of a group are a run inside a partition.
    runs = tagged.groupBy("_pid", *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_lo"))
    earlier = Window.partitionBy(*within).orderBy("_pid", "_lo").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_pid", *within, "_lo", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    out = tagged.join(F.broadcast(runs), ["_pid", *within], "left").withColumn(
        id_col, (F.col("_off") + F.col("_pos") - F.col("_lo") + start_col).cast("bigint"))
    return out.withColumns(dict(rebuilt or {})).select(*[c for c in columns if c != id_col], id_col)


# Rows that one task may number alone: those of a stream's batch, some MB.
FEW_ROWS = 50_000

# Ids of a dense column that one range holds at least.
RANGE_IDS = 10_000


def _ranges(df: DataFrame, order_cols: Sequence[str], col: str, n: int) -> tuple[int, Column]:
    """Number of equal ranges of the ids 1..n in ``col`` and the range of a row; a row without an id goes by its other columns."""
    parts = max(1, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE_IDS)))
    spread = F.pmod(F.hash(*order_cols), F.lit(parts))
    return parts, F.coalesce(F.floor((F.col(col) - 1) * parts / n).cast("int"), spread).cast("int")
