"""SQL over registered views, with bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(tables: dict[str, DataFrame]) -> None:
    """Register each frame as a temporary view under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, args: dict[str, object] | None = None) -> DataFrame:
    """Run SQL with named parameters (``:name`` markers), never string
    formatting, so values cannot change the statement."""
    return spark.sql(text, args=args or None)
