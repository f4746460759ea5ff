"""Table shape profile: row and column counts of named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_spark.operators.setops import union_all


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name``, ``n_rows``, ``n_cols``.

    Each count is a distributed global aggregate (no rows reach the driver);
    the per-table results are unioned into one frame.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
        )
        for name, df in tables.items()
    ]
    return union_all(parts)
