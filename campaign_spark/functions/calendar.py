"""Calendar features of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from campaign_spark.fixed import YEAR_MONTH_FORMAT


def year_of(date_col: str | Column) -> Column:
    """Calendar year as INT; NULL for a NULL date."""
    return F.year(date_col).cast("int")


def year_month_of(date_col: str | Column) -> Column:
    """Zero-padded ``yyyyMM`` string (e.g. ``'201809'``); NULL for a NULL date."""
    return F.date_format(date_col, YEAR_MONTH_FORMAT)
