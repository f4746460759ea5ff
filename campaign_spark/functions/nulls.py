"""Null-handling expressions matching the campaign semantics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_spark.fixed import NA_LABEL as NA


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_label(c: str | Column) -> Column:
    """Value rendered as a string, with NULL shown as ``'NA'``."""
    return F.coalesce(_col(c).cast("string"), F.lit(NA))


def nonnull_sum(c: str | Column) -> Column:
    """Sum that skips missing values (NULL, NaN) and gives 0.0 (not NULL) for an all-null group."""
    return F.coalesce(F.sum(present(c)), F.lit(0.0))


def present(c: str | Column) -> Column:
    """The value, with NaN as NULL: both are missing."""
    return F.when(~F.isnan(_col(c)), _col(c))


def nan_to_null(df: DataFrame) -> DataFrame:
    """``df`` with NaN in its floating-point columns as NULL."""
    return df.withColumns({n: present(F.col(f"`{n}`")) for n, t in df.dtypes if t in ("double", "float")})


def null_safe_differs(a: str | Column, b: str | Column) -> Column:
    """``a != b`` where a NULL on either side counts as different, including
    NULL vs NULL (like NaN in floating point); never NULL itself."""
    return ~F.coalesce(_col(a) == _col(b), F.lit(False))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose every key is non-NULL (group-by semantics that drop NULL
    keys). Written as ``IS NOT NULL`` predicates, which reach the Parquet
    reader as pushed filters (``dropna`` plans an opaque non-null count)."""
    if not keys:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
