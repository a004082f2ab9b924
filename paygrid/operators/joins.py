"""The reject-split join: tag every row with its first failing rule, then filter twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reject_split(tagged: DataFrame, error_col: str = "_erro") -> tuple[DataFrame, DataFrame]:
    """Split a frame tagged with an error message column into (accepted, rejected).

    Pass a written frame, so that the join behind the tag runs once for both halves.
    """
    ok = tagged.filter(F.col(error_col).isNull()).drop(error_col)
    bad = tagged.filter(F.col(error_col).isNotNull())
    return ok, bad


def first_error(*checks: tuple[Column, str]) -> Column:
    """First message whose condition holds (checks in precedence order), else NULL."""
    out = None
    for cond, msg in checks:
        out = F.when(cond, F.lit(msg)) if out is None else out.when(cond, F.lit(msg))
    return out
