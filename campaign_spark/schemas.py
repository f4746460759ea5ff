"""Explicit schemas for every table the library reads or produces.

Column names are snake_case versions of the campaign data model: one fact
(``camp_data``) keyed to three label dimensions, the joined wide table, the
cleansed table (two median helper columns kept) and the engineered table.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw campaign fact as loaded from CSV (typed DDL of the source system).
CAMP_DATA = T.StructType([
    T.StructField("captured_date", T.DateType()),
    T.StructField("business_vertical_id", T.IntegerType()),
    T.StructField("country_id", T.IntegerType()),
    T.StructField("region", T.StringType()),
    T.StructField("city_code", T.StringType()),
    T.StructField("strategy_id", T.LongType()),
    T.StructField("channel_name_id", T.IntegerType()),
    T.StructField("goal_type", T.DoubleType()),
    T.StructField("total_spend_cpm", T.DoubleType()),
    T.StructField("impressions", T.DoubleType()),
    T.StructField("clicks", T.DoubleType()),
    T.StructField("conversions", T.DoubleType()),
])


def label_dimension(id_col: str, label_col: str) -> T.StructType:
    """(id, label) dimension table schema."""
    return T.StructType([
        T.StructField(id_col, T.IntegerType(), nullable=False),
        T.StructField(label_col, T.StringType()),
    ])


BUSINESS_VERTICAL = label_dimension("business_vertical_id", "business_vertical")
CHANNEL_NAME = label_dimension("channel_name_id", "channel_name")
COUNTRY = label_dimension("country_id", "country")

# Column order of the joined ("wide") campaign table.
JOINED_COLUMNS = [
    "captured_date", "business_vertical", "country", "region", "city_code",
    "strategy_id", "channel_name", "goal_type", "total_spend_cpm",
    "impressions", "clicks", "conversions",
]

JOINED = T.StructType([
    T.StructField("captured_date", T.DateType()),
    T.StructField("business_vertical", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("city_code", T.StringType()),
    T.StructField("strategy_id", T.LongType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("goal_type", T.DoubleType()),
    T.StructField("total_spend_cpm", T.DoubleType()),
    T.StructField("impressions", T.DoubleType()),
    T.StructField("clicks", T.DoubleType()),
    T.StructField("conversions", T.DoubleType()),
])

MEASURES = ["impressions", "clicks", "conversions"]
SPEND = "total_spend_cpm"
BREAKDOWN_KEYS = ["country", "channel_name", "business_vertical"]
MARKET_KEYS = ["country", "region"]

# Ratings / items (movie-style) inputs.
ITEMS = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
])

# Same inputs as all-string CSV columns, for raw reads that are cast later.
RATINGS_TEXT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("movie_id", T.StringType()),
    T.StructField("rating", T.StringType()),
])
