"""Last-date analysis: each group's last date and the rows before / on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_spark.functions.nulls import drop_null_keys, null_safe_differs
from campaign_spark.operators.joins import attach_group_value


def last_date_per(df: DataFrame, key: str, date_col: str, name: str = "last_date") -> DataFrame:
    """``key``, ``name`` = max(date) per key (NULL keys dropped)."""
    return drop_null_keys(df, [key]).groupBy(key).agg(F.max(date_col).alias(name))


def with_last_date(df: DataFrame, key: str, date_col: str, name: str = "last_date") -> DataFrame:
    """Every row with its group's last date (left join; NULL key -> NULL)."""
    return attach_group_value(df, [key], F.max(date_col), name)


def split_on_last_date(
    df: DataFrame, key: str, date_col: str, name: str = "last_date"
) -> tuple[DataFrame, DataFrame]:
    """(rows before the last date, rows on it). A row whose date or last date
    is NULL counts as "before" (NULL differs from any date), so the two parts
    always add up to the whole table."""
    joined = with_last_date(df, key, date_col, name)
    before = joined.where(null_safe_differs(date_col, name))
    on = joined.where(F.col(date_col) == F.col(name))
    return before, on
