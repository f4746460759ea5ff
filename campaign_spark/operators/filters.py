"""Row filters: equality, date bounds, null tests and HAVING-style filters.

Predicates are plain Catalyst expressions, so over a Parquet scan they are
pushed into the reader (row-group skipping) and, behind joins, below them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_rows(
    df: DataFrame,
    equals: dict[str, object] | None = None,
    date_col: str | None = None,
    date_from: dt.date | None = None,
    date_before: dt.date | None = None,
    date_to: dt.date | None = None,
) -> DataFrame:
    """Keep rows with ``col == value`` for every item of ``equals`` and the
    date within ``[date_from, ...]``: ``date_before`` is exclusive,
    ``date_to`` inclusive. A NULL date fails any bound."""
    cond: Column = F.lit(True)
    for col, value in (equals or {}).items():
        cond = cond & (F.col(col) == F.lit(value))
    if date_col is not None:
        d = F.col(date_col)
        if date_from is not None:
            cond = cond & (d >= F.lit(date_from))
        if date_before is not None:
            cond = cond & (d < F.lit(date_before))
        if date_to is not None:
            cond = cond & (d <= F.lit(date_to))
    return df.where(cond)


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` IS NULL."""
    return df.where(F.col(col).isNull())


def non_null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` IS NOT NULL."""
    return df.where(F.col(col).isNotNull())


def having(df: DataFrame, cond: Column) -> DataFrame:
    """Filter an aggregated frame (post-aggregate predicate)."""
    return df.where(cond)
