"""Null cleansing: constant fills, integer casts and group-median imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_spark.operators.ordering import written
from campaign_spark.operators.quantiles import group_medians

from campaign_spark.functions.nulls import present
from campaign_spark.fixed import FILL_CONSTANTS as DEFAULT_CONSTANTS
from campaign_spark.fixed import INT_COLUMNS as DEFAULT_INT_COLUMNS
from campaign_spark.fixed import MEDIAN_COLUMNS as DEFAULT_MEDIAN_COLUMNS
from campaign_spark.fixed import MEDIAN_KEYS as DEFAULT_MEDIAN_KEYS


def fill_constants(df: DataFrame, constants: dict[str, float]) -> DataFrame:
    """Replace NULLs of the given columns with constants."""
    return df.fillna(constants)


def cast_int(df: DataFrame, cols: list[str]) -> DataFrame:
    """DOUBLE -> INT, truncating toward zero."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def impute_group_median(
    df: DataFrame,
    keys: list[str],
    cols: list[str],
    prefix: str = "median_",
    method: str = "bucketed",
) -> DataFrame:
    """Fill NULLs of ``cols`` with the exact median of the row's ``keys`` group.

    The per-group medians are kept as ``{prefix}{col}`` columns. Rows whose
    key has a NULL part are not imputed (their group does not exist), and
    neither are rows of a group with no non-null value. The median table has
    one row per group; it is written, so that the equi-join that brings it back
    is planned by its size: a small one is broadcast and no row is shuffled.
    """
    medians = written(group_medians(df, keys, cols, prefix, method), "medians")
    joined = df.join(medians, keys, "left")
    filled = joined.withColumns({c: F.coalesce(present(c), F.col(prefix + c)) for c in cols})
    return filled.select(*df.columns, *[prefix + c for c in cols])


def cleanse(
    df: DataFrame,
    constants: dict[str, float] | None = None,
    int_cols: list[str] | None = None,
    median_cols: list[str] | None = None,
    median_keys: list[str] | None = None,
    method: str = "bucketed",
) -> DataFrame:
    """The cleansed campaign table: joined columns + ``median_*`` helpers.

    Medians are taken from the data *after* the constant fills, which does
    not touch the median columns, so the order of the steps is immaterial.
    """
    constants = DEFAULT_CONSTANTS if constants is None else constants
    int_cols = DEFAULT_INT_COLUMNS if int_cols is None else int_cols
    median_cols = DEFAULT_MEDIAN_COLUMNS if median_cols is None else median_cols
    median_keys = DEFAULT_MEDIAN_KEYS if median_keys is None else median_keys
    out = cast_int(fill_constants(df, constants), int_cols)
    return impute_group_median(out, median_keys, median_cols, method=method)
