"""File sources: typed and inferred CSV, Parquet, and the campaign CSV set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_spark import schemas


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             mode: str = "FAILFAST", **options: str) -> DataFrame:
    """CSV with a header. With ``schema`` the columns are typed on read
    (``mode`` decides what a malformed row does); without one every column
    is read as a string. Schema inference is opt-in via ``inferSchema``."""
    reader = spark.read.option("header", "true").option("mode", mode)
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


CORRUPT = "_corrupt_record"


def read_csv_inferred(spark: SparkSession, path: str, corrupt: str = CORRUPT) -> DataFrame:
    """CSV with a header and inferred column types (an extra pass over the
    file; meant for profiling unknown inputs, not for production loads).

    A line that does not fit the inferred columns is kept whole in ``corrupt``
    (null elsewhere), so bad rows can be counted and looked at, not lost.
    """
    options = {"header": "true", "mode": "PERMISSIVE"}
    inferred = spark.read.options(**options, inferSchema="true").csv(path).schema
    # Whole lines are checked, whichever columns a query reads.
    return (spark.read.options(**options, columnNameOfCorruptRecord=corrupt, columnPruning="false")
            .schema(T.StructType([*inferred.fields, T.StructField(corrupt, T.StringType())])).csv(path))


def inferred_profile(df: DataFrame, corrupt: str = CORRUPT) -> DataFrame:
    """One row per column of an inferred scan: ``column_name``, ``inferred_type``, ``n_values`` (not null, in
    rows that fit) and ``n_bad_rows`` (of the whole file); one aggregate over the file."""
    fits = F.col(corrupt).isNull()
    fields = [f for f in df.schema.fields if f.name != corrupt]
    counts = df.agg(*[F.count_if(fits & F.col(f"`{f.name}`").isNotNull()).alias(f"_{i}") for i, f in enumerate(fields)],
                    F.count_if(~fits).alias("_bad"))
    lines = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("inferred_type"),
                               F.col(f"_{i}").alias("n_values"), F.col("_bad").alias("n_bad_rows")) for i, f in enumerate(fields)])
    return counts.select(F.explode(lines).alias("_l")).select("_l.*")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (vectorized; filters and column pruning pushed down)."""
    return spark.read.parquet(path)


def read_campaign_csvs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four campaign CSVs with their typed schemas: ``camp_data``,
    ``business_vertical``, ``channel_name``, ``country``."""
    base = folder.rstrip("/")
    return {
        "camp_data": read_csv(spark, f"{base}/camp_data.csv", schemas.CAMP_DATA),
        "business_vertical": read_csv(spark, f"{base}/business_vertical.csv", schemas.BUSINESS_VERTICAL),
        "channel_name": read_csv(spark, f"{base}/channel_name.csv", schemas.CHANNEL_NAME),
        "country": read_csv(spark, f"{base}/country.csv", schemas.COUNTRY),
    }


def load_csv_table(spark: SparkSession, path: str, schema: T.StructType, table: str,
                   location: str | None = None) -> DataFrame:
    """Typed bulk load: drop table ``table`` if it is there, create it from the CSV and read it by name.

    FAILFAST: a malformed row fails the load, and the table is not created. With
    ``location`` the table's files stand there and outlive a drop.
    """
    df = read_csv(spark, path, schema, mode="FAILFAST")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.write.format("parquet").mode("errorifexists")
    (writer.option("path", location) if location else writer).saveAsTable(table)
    return spark.table(table)


def typed_ratings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cast all-string ratings to the typed schema.

    Returns (good rows, rejected rows). A row is rejected when an id or the
    rating does not parse; nothing is silently dropped.
    """
    typed = raw.select(
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.col("movie_id").try_cast("bigint").alias("movie_id"),
        F.col("rating").try_cast("double").alias("rating"),
        F.col("user_id").alias("_u"), F.col("movie_id").alias("_m"), F.col("rating").alias("_r"),
    )
    bad = ((F.col("_u").isNotNull() & F.col("user_id").isNull())
           | (F.col("_m").isNotNull() & F.col("movie_id").isNull())
           | (F.col("_r").isNotNull() & F.col("rating").isNull()))
    good = typed.where(~bad).select("user_id", "movie_id", "rating")
    rejected = typed.where(bad).select(F.col("_u").alias("user_id"), F.col("_m").alias("movie_id"),
                                       F.col("_r").alias("rating"))
    return good, rejected
