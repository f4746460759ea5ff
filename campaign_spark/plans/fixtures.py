"""Binding of the TPC-H-style test tables to the campaign and ratings models.

Campaign fact = one row per ``lineitem``; its labels come from a star join:
the geography dimension (nation + region; rows of one nation get no key and so
no country) and the vertical dimension (part; rows of every tenth part get no
key) and the channel dimension (the distinct order priorities, keyed by their
digit). Measures are derived from lineitem
columns with deterministic NULLs so that every cleansing rule is exercised.
The last three columns are tie-breakers for ordered operations.

Every lineitem row is kept (all joins are LEFT joins) and the dimensions are
read whole; the missing keys exercise the NULL-key rules.

Ratings: user = the order's customer, item = the part, rating = quantity.
Items: id = part key, title = brand, categories = the part name's words
joined with ``|``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_spark.operators.joins import Dimension, star_join
from campaign_spark.schemas import JOINED_COLUMNS

# Fixed values of the binding (must equal the oracle SQL).
EXCLUDED_NATION = 13
EXCLUDED_PART_MODULUS = 10
TIEBREAK = ["l_orderkey", "l_partkey", "l_linenumber"]
CAMPAIGN_TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]
CAMPAIGN_COLUMNS = [*JOINED_COLUMNS, *TIEBREAK]


_TABLES: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table (lazy Parquet scan). The resolved relation is reused
    per session, so its file listing and footer read happen once, not in
    every query that names the table."""
    path = f"{str(sf_dir).rstrip('/')}/{name}.parquet"
    hit = _TABLES.get((id(spark), path))
    if hit is not None and hit[0] is spark:
        return hit[1]
    df = spark.read.parquet(path)
    _TABLES[(id(spark), path)] = (spark, df)
    return df


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channel dimension (channel_id, channel_label): the distinct order priorities, keyed by their digit."""
    label = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("channel_label")).distinct()
    return label.select(channel_id("channel_label").alias("channel_id"), "channel_label")


def channel_id(priority: str) -> Column:
    return F.substring(priority, 1, 1).cast("int")


def campaign_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined campaign table: ``JOINED_COLUMNS`` + tie-break columns."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    # orders LEFT JOIN customer first: the smaller side of the big join gets
    # its customer attribute before meeting lineitem (same result as joining
    # lineitem to orders, then to customer).
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    order_geo = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").drop("c_custkey")
    fact = li.join(order_geo, li.l_orderkey == order_geo.o_orderkey, "left").drop("o_orderkey")
    # Some facts have no label: their key, not the dimension's row, is left out.
    fact = fact.withColumns({
        "c_nationkey": F.when(F.col("c_nationkey") != EXCLUDED_NATION, F.col("c_nationkey")),
        "part_key": F.when(F.col("l_partkey") % EXCLUDED_PART_MODULUS != 0, F.col("l_partkey")),
        "channel_key": channel_id("o_orderpriority")})

    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", "r_name", "n_name")
    verticals = table(spark, sf_dir, "part").select("p_partkey", "p_type")

    joined = star_join(fact, [
        Dimension(geo, "c_nationkey", "n_nationkey", {"r_name": "country", "n_name": "region"}),
        Dimension(verticals, "part_key", "p_partkey", {"p_type": "business_vertical"}),
        Dimension(channels(spark, sf_dir), "channel_key", "channel_id", {"channel_label": "channel_name"}),
    ])
    ln = F.col("l_linenumber")
    return joined.select(
        F.col("l_shipdate").cast("date").alias("captured_date"),
        "business_vertical",
        "country",
        "region",
        F.when(F.col("o_orderstatus") == "P", F.col("channel_name"))
        .otherwise(F.concat(F.col("country"), F.lit("-"), F.col("channel_name"))).alias("city_code"),
        F.col("l_suppkey").alias("strategy_id"),
        "channel_name",
        F.when(ln % 3 == 0, F.lit(None).cast("double")).otherwise((ln % 3).cast("double")).alias("goal_type"),
        F.col("l_tax").alias("total_spend_cpm"),
        F.when(ln == 7, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("impressions"),
        F.when(ln == 6, F.lit(None).cast("double"))
        .otherwise(F.round(F.col("l_discount") * 100).cast("double")).alias("clicks"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double"))
        .otherwise(ln.cast("double")).alias("conversions"),
        *TIEBREAK,
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, movie_id, rating) events."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").cast("double").alias("rating"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movie_id, title, genres) items."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_brand").alias("title"),
        F.regexp_replace(F.col("p_name"), " ", "|").alias("genres"),
    )


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The test tables the campaign binding reads."""
    return {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part")}
