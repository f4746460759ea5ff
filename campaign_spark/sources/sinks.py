"""File sinks. Executors write in parallel; nothing goes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, cluster_by: list[str] | None = None,
                  clusters: int | None = None) -> None:
    """Snappy Parquet, one file per task (optionally partitioned folders).

    ``cluster_by`` range-partitions and sorts the rows, so the column bounds of
    files and row groups are narrow and a reader with a filter on the leading
    column skips most of them. Name columns that tell rows apart after the one to
    filter on: a value that holds most rows is then cut into several ranges.
    ``clusters`` fixes the number of ranges.
    """
    if cluster_by:
        df = df.repartitionByRange(clusters, *cluster_by) if clusters else df.repartitionByRange(*cluster_by)
        df = df.sortWithinPartitions(*cluster_by)
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, one file per task (any size)."""
    df.write.mode(mode).option("header", "true").csv(path)
