"""Chunked scan as a Spark data source: one partition per half-open period window.

The reference fetches a large source through one cursor, chunk after chunk on one thread. Here every window
``[lo, hi)`` of the period column is a partition that a task of its own reads as Arrow batches, so
windows are read side by side, a lost task reads its window again, and a filter on the period column
leaves only the windows it touches (``pushFilters``). Rows without a period form one more window.

    register(spark)
    spark.read.format("payroll_chunks").option("path", folder).option("column", "o_orderdate").load()

Options: ``path`` (parquet file or folder that the driver and all executors can open), ``column`` (date or timestamp), ``months``
(months per window, 1). Windows follow from the column's statistics in the file footers; where a file
has none, the column itself is read once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual)
from pyspark.sql.types import StructField, StructType, TimestampType

FORMAT = "payroll_chunks"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class Window(InputPartition):
    """Rows whose period is in ``[lo, hi)``; both None: rows without a period."""

    lo: dt.date | None
    hi: dt.date | None


def month_windows(first: dt.date, last: dt.date, months: int = 1) -> list[Window]:
    """Consecutive half-open windows of whole months that cover ``first`` to ``last``."""
    if months < 1:
        raise ValueError("a window has one month at least")
    at, out = first.year * 12 + first.month - 1, []
    while at <= last.year * 12 + last.month - 1:
        to = at + months
        out.append(Window(dt.date(at // 12, at % 12 + 1, 1), dt.date(to // 12, to % 12 + 1, 1)))
        at = to
    return out


def _day(value) -> dt.date:
    return value.date() if isinstance(value, dt.datetime) else value


class PeriodReader(DataSourceReader):
    def __init__(self, path: str, column: str, months: int, schema: StructType):
        self.path, self.column, self.months, self.schema = path, column, months, schema
        self.lo: dt.date | None = None          # bounds that pushed filters leave, inclusive and exclusive
        self.hi: dt.date | None = None
        self.nulls = True

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrow the windows; every filter is handed back, since a window holds more than the filter asks for."""
        for f in filters:
            if getattr(f, "attribute", None) == (self.column,):
                self._narrow(f)
            yield f

    def _narrow(self, f: Filter) -> None:
        if isinstance(f, IsNull):
            self.lo, self.hi = dt.date.max, dt.date.min
            return
        if not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan, LessThanOrEqual)):
            return
        self.nulls = False
        if isinstance(f, IsNotNull):
            return
        days = [_day(v) for v in (f.value if isinstance(f, In) else [f.value]) if v is not None]
        # An instant may fall on the day before or after, depending on the time zone.
        slack = dt.timedelta(days=isinstance(self.schema[self.column].dataType, TimestampType))
        if not days:
            self.lo, self.hi = dt.date.max, dt.date.min
            return
        if not isinstance(f, (LessThan, LessThanOrEqual)):
            self.lo = min(days) - slack if self.lo is None else max(self.lo, min(days) - slack)
        if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            whole = isinstance(f, LessThan) and (not isinstance(f.value, dt.datetime) or f.value.time() == dt.time())
            end = max(days) + dt.timedelta(days=0 if whole else 1) + slack
            self.hi = end if self.hi is None else min(self.hi, end)

    def _bounds(self) -> tuple[dt.date | None, dt.date | None, bool]:
        """First and last day of the column and whether it has nulls, from the footers."""
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        found, nulls = [], False
        for part in ds.dataset(self.path, format="parquet").get_fragments():
            for group in part.split_by_row_group():
                info = group.row_groups[0]
                stats = (info.statistics or {}).get(self.column)
                meta = group.metadata.row_group(info.id)
                k = next(i for i in range(meta.num_columns) if meta.column(i).path_in_schema == self.column)
                counted = meta.column(k).statistics
                if stats and counted is not None and counted.has_null_count:
                    found += [_day(stats["min"]), _day(stats["max"])]
                    nulls |= counted.null_count > 0
                elif group.count_rows():
                    values = group.to_table(columns=[self.column], use_threads=False)[self.column]
                    nulls |= values.null_count > 0
                    both = pc.min_max(values).as_py()
                    found += [_day(v) for v in both.values() if v is not None]
        return (min(found), max(found), nulls) if found else (None, None, nulls)

    def partitions(self) -> list[Window]:
        first, last, nulls = self._bounds()
        out = [] if first is None else month_windows(first, last, self.months)
        out = [w for w in out if (self.lo is None or w.hi > self.lo) and (self.hi is None or w.lo < self.hi)]
        return out + ([Window(None, None)] if nulls and self.nulls else [])

    def read(self, partition: Window | None):
        if partition is None:           # no window is left
            return
        import pyarrow as pa
        import pyarrow.dataset as ds

        data = ds.dataset(self.path, format="parquet")
        kind, col = data.schema.field(self.column).type, ds.field(self.column)
        if partition.lo is None:
            wanted = col.is_null()
        else:
            lo, hi = (pa.scalar(dt.datetime.combine(d, dt.time()), kind) if pa.types.is_timestamp(kind) else pa.scalar(d, kind)
                      for d in (partition.lo, partition.hi))
            wanted = (col >= lo) & (col < hi)
        for batch in data.to_batches(filter=wanted, columns=self.schema.names, use_threads=False):
            if batch.num_rows:
                yield batch


class PeriodChunks(DataSource):
    """``payroll_chunks``: see the module."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import from_arrow_schema

        found = from_arrow_schema(ds.dataset(self.options["path"], format="parquet").schema, prefer_timestamp_ntz=True)
        return StructType([StructField(f.name, f.dataType, True) for f in found])

    def reader(self, schema: StructType) -> PeriodReader:
        if self.options["column"] not in schema.names:
            raise ValueError(f"no column {self.options['column']!r} to cut windows by")
        return PeriodReader(self.options["path"], self.options["column"], int(self.options.get("months", "1")), schema)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach it."""
    spark.dataSource.register(PeriodChunks)
    spark.conf.set(PUSHDOWN, "true")
