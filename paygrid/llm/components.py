"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.session import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step over edges ``a > b``: neighbours of a node move to its smallest neighbour.

    The large step moves the larger neighbours, the small step the smaller ones and the node.
    The minimum is an aggregate joined back, so a node with many neighbours is pre-aggregated
    on the map side and split by the skewed join.
    """
    if small:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .filter("a > b").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest reachable node) of every node of ``edges (a, b)``.

    Each round is written to the checkpoint folder, which cuts the lineage.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    e = materialize(e, "components")
    before = None
    while True:
        e = materialize(_star(_star(e, small=False), small=True), "components")
        # Stars of depth one no longer change: same edges, compared by count and an order-free digest.
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
