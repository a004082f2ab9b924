"""Row counts taken by the jobs that write the rows.

A watched frame carries observed metrics (``DataFrame.observe``): the job that writes it counts on the way, so no
frame is read again for counting. Watch the frame that is handed to the write: its rows pass in the job's
last stage, whose tasks count once however often executors are lost.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


class Counts:
    """Named counts of watched frames; a count is there once its frame was written."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, **metrics: Column) -> Callable[[DataFrame], DataFrame]:
        """A function that adds the metrics to a frame; the last frame watched under a name counts."""
        def add(df: DataFrame) -> DataFrame:
            seen = Observation()
            self._seen.update(dict.fromkeys(metrics, seen))
            return df.observe(seen, *[c.alias(name) for name, c in metrics.items()])
        return add

    def __contains__(self, name: str) -> bool:
        return name in self._seen

    def __getitem__(self, name: str) -> int:
        # A frame that the planner proves empty is written without running its metrics.
        return int(self._seen[name].get.get(name) or 0)

    def row(self, spark: SparkSession, names: Sequence[str], **more: int) -> DataFrame:
        """The named counts, and the given ones, side by side in one row."""
        values = {n: self[n] for n in names} | more
        return spark.range(1).select(*[F.lit(v).cast("bigint").alias(n) for n, v in values.items()])
