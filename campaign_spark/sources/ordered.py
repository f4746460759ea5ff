"""Sorted results as CSV: many files in one order, and their re-read in that order.

``write_sorted_csv`` partitions the rows by ranges of the whole sort key. The
number in a file's name is the number of its range, and rows are sorted inside
each file, so the files read by name are the sorted result, whatever its size;
no task ever holds more than a range.

A CSV scan has no row numbers of its own. ``read_in_order`` takes a row's place
from the file's name, the split's start in the file and the order in which the
split is read; ``first_rows`` reads no more files than the rows asked for need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_spark.operators.ordering import written
from campaign_spark.sources.files import read_csv
from campaign_spark.sources.stages import hadoop_fs

ROWS_PER_FILE = 1_000_000


def write_sorted_csv(df: DataFrame, path: str, order_by: list[str | Column], mode: str = "overwrite",
                     rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write ``df`` sorted by ``order_by`` as about rows / ``rows_per_file`` CSV files with headers; returns how many
    ranges were asked for.

    The rows are staged once, so that counting them does not compute them
    twice. ``order_by`` should end in columns that tell rows apart: rows with
    equal keys stay in one file.
    """
    rows = written(df, "sorted-csv")
    ranges = max(1, -(-rows.count() // rows_per_file))
    (rows.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)
     .write.mode(mode).option("header", "true").csv(path))
    return ranges


def result_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a result folder, in the order of their names (that of their ranges)."""
    fs, p = hadoop_fs(spark, path)
    found = [f.getPath() for f in fs.listStatus(p) if f.isFile()]
    return [f.toString() for f in sorted(found, key=lambda f: f.getName()) if f.getName().startswith("part-")]


def _with_place(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_block_start").alias("__split"),
                     F.monotonically_increasing_id().alias("__place"))


def read_in_order(spark: SparkSession, path: str, schema: T.StructType, position: str = "position") -> DataFrame:
    """The rows of a sorted result with ``position`` (from 1) in its order.

    A row's position is the number of rows of earlier splits (a sum over one
    row per split) plus its number inside its split; no task sees more than a split.
    """
    rows = _with_place(read_csv(spark, path, schema))
    splits = rows.groupBy("__file", "__split").agg(F.count("*").alias("__n"))
    upto = Window.orderBy("__file", "__split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("__file", "__split", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__file", "__split").orderBy("__place"))
    numbered = rows.withColumn("__inside", inside).join(splits, ["__file", "__split"])
    return numbered.select(*schema.fieldNames(), (F.col("__before") + F.col("__inside")).cast("long").alias(position))


def first_rows(spark: SparkSession, path: str, schema: T.StructType, n: int, position: str | None = None) -> DataFrame:
    """The first ``n`` rows of a sorted result, from as few of its first files as hold them."""
    files, use = result_files(spark, path), 1
    if not files:
        raise FileNotFoundError(f"no result files in {path}")
    while use < len(files) and read_csv(spark, files[:use], schema).limit(n).count() < n:
        use *= 2
    rows = _with_place(read_csv(spark, files[:use], schema))
    order = ["__file", "__split", "__place"]
    top = rows.orderBy(*order).limit(n)
    if position:  # n rows: one window over the report itself
        top = top.withColumn(position, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return top.select(*schema.fieldNames(), *([position] if position else []))
