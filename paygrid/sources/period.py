"""Period window (A1) and the source scans that use it (A2, A3, A5).

The window is half-open ``[lo, hi)``: an explicit date range wins (its end is
inclusive, so ``hi = end + 1 day``); else a month; else a whole year. The filter
compares the raw date column with literals so that Catalyst pushes it into the
parquet / JDBC scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def period_window(year: int, month: int | None = None,
                  start_date: dt.date | None = None,
                  end_date: dt.date | None = None) -> tuple[dt.date, dt.date]:
    if start_date is not None and end_date is not None:
        return start_date, end_date + dt.timedelta(days=1)
    if month is not None:
        lo = dt.date(year, month, 1)
        hi = dt.date(year + 1, 1, 1) if month == 12 else dt.date(year, month + 1, 1)
        return lo, hi
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def filter_period(df: DataFrame, column: str, year: int | None, month: int | None = None,
                  start_date: dt.date | None = None, end_date: dt.date | None = None) -> DataFrame:
    """Keep rows of ``column`` inside the window; ``year=None`` keeps everything."""
    if year is None:
        return df
    lo, hi = period_window(year, month, start_date, end_date)
    c = F.col(column)
    return df.filter((c >= F.lit(lo)) & (c < F.lit(hi)))


def scan_folhas(folhas: DataFrame, year: int | None = None, month: int | None = None,
                start_date: dt.date | None = None, end_date: dt.date | None = None) -> DataFrame:
    """A2: the five run columns inside the period."""
    cols = ["MES_ANO_FOLHA", "NUM_FOLHA", "FOLHA", "DATA_CONSOLIDACAO", "DT_LIB_C_CHEQUE"]
    extra = [c for c in folhas.columns if c == "SRC_ORDER"]
    return filter_period(folhas.select(*cols, *extra), "MES_ANO_FOLHA", year, month, start_date, end_date)


def scan_contracheques(checks: DataFrame, year: int | None = None, month: int | None = None,
                       start_date: dt.date | None = None, end_date: dt.date | None = None) -> DataFrame:
    """A3: the wide source inside the period."""
    return filter_period(checks, "MES_ANO", year, month, start_date, end_date)


def source_counts(checks: DataFrame, folhas: DataFrame, year: int | None = None,
                  month: int | None = None, start_date: dt.date | None = None,
                  end_date: dt.date | None = None) -> DataFrame:
    """A5: COUNT(1) of both sources over the same window, as one row."""
    f = scan_folhas(folhas, year, month, start_date, end_date).select(F.lit(1).alias("is_folha"))
    c = scan_contracheques(checks, year, month, start_date, end_date).select(F.lit(0).alias("is_folha"))
    # One pass over the union: two scalar counts without joining the aggregates.
    return f.unionByName(c).agg(
        F.sum("is_folha").cast("bigint").alias("qtd_folhas"),
        F.sum(1 - F.col("is_folha")).cast("bigint").alias("qtd_linhas_contracheque"),
    )
