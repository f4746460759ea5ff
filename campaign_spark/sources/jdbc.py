"""Relational database source and sink through Spark's JDBC data source.

Reads run one connection per partition: give ``partition`` (column, lower,
upper, count) to split a table scan by ranges of a numeric/date column;
filters and column selections on the result are pushed into the database
query. Writes run one connection and transaction per task, inserting in
batches of ``batchsize`` rows. No database driver is bundled: pass the
driver class of your database (its jar must be on the classpath).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class RangePartition:
    """Split a JDBC table read into ``num_partitions`` ranges of ``column``."""

    column: str
    lower: int | str
    upper: int | str
    num_partitions: int


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    fetchsize: int = 1000,
    partition: RangePartition | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table (``table``) or a query (``query``) from a database."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    if partition is not None and query is not None:
        raise ValueError("range partitioning needs table= (a subquery may be passed as '(...) t')")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    reader = reader.option("dbtable", table) if table is not None else reader.option("query", query)
    if partition is not None:
        reader = (reader.option("partitionColumn", partition.column)
                  .option("lowerBound", str(partition.lower))
                  .option("upperBound", str(partition.upper))
                  .option("numPartitions", str(partition.num_partitions)))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def column_types_option(colnames: list[str], coltypes: list[str]) -> str:
    """``createTableColumnTypes`` value from parallel name / type lists.

    Types are Spark SQL DDL types (``INT``, ``DOUBLE``, ``DATE``,
    ``VARCHAR(200)``, ``CHAR(1)``, ...); Spark validates them and the JDBC
    dialect renders them for the database. Columns left out keep the
    dialect's default mapping."""
    if len(colnames) != len(coltypes):
        raise ValueError("colnames and coltypes differ in length")
    return ", ".join(f"{n} {t}" for n, t in zip(colnames, coltypes))


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batchsize: int = 100,
    colnames: list[str] | None = None,
    coltypes: list[str] | None = None,
    num_partitions: int | None = None,
    truncate: bool = False,
    properties: dict[str, str] | None = None,
) -> None:
    """Create-or-replace (``overwrite``) or append to ``table``.

    ``colnames`` renames the frame's columns in order; ``coltypes`` (Spark
    SQL DDL types, e.g. ``VARCHAR(200)``) override the dialect's default
    column types of a created table. NULL doubles are written as SQL NULL.
    ``num_partitions`` caps concurrent connections.
    """
    out = df
    if colnames is not None:
        if len(colnames) != len(df.columns):
            raise ValueError("colnames must name every column of the frame")
        out = df.toDF(*colnames)
    writer = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", str(batchsize)).option("truncate", str(truncate).lower()))
    if colnames is not None and coltypes is not None:
        writer = writer.option("createTableColumnTypes", column_types_option(colnames, coltypes))
    if num_partitions is not None:
        writer = writer.option("numPartitions", str(num_partitions))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()
