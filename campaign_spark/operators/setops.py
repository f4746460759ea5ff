"""Set operations: distinct keys and values, union and key-set difference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from campaign_spark.functions.nulls import na_label


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct key tuples (NULLs kept and equal to each other)."""
    return df.select(*keys).distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` as strings, NULL shown as ``'NA'``."""
    return df.select(na_label(col).alias(col)).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct key tuples of ``left`` absent from ``right`` (EXCEPT DISTINCT,
    NULL-safe). Runs as a shuffled anti-join on the keys."""
    return left.select(*keys).subtract(right.select(*keys))


def drop_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key tuple (which row survives is unspecified)."""
    return df.dropDuplicates(keys)


__all__ = ["distinct_keys", "distinct_values", "union_all", "key_difference", "drop_duplicate_keys"]
