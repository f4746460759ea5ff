import datetime as dt
import uuid

from pyspark.sql import functions as F

from campaign_spark.operators import (
    drop_duplicate_keys, filter_rows, group_quantiles, having, last_date_per, maybe_broadcast,
    non_null_rows, quantiles_long, value_counts_within, with_last_date,
)
from campaign_spark.session import scratch_path
from campaign_spark.sources import read_parquet, write_csv, write_parquet
from tests.conftest import rows

D = dt.date


def _dated(spark):
    return spark.createDataFrame(
        [(1, D(2018, 9, 1), 1.0), (1, D(2018, 9, 18), None), (2, D(2018, 9, 19), 3.0), (1, None, 4.0)],
        "s int, d date, x double")


def test_filter_rows_bounds(spark):
    df = _dated(spark)
    assert rows(filter_rows(df, equals={"s": 1}, date_col="d", date_to=D(2018, 9, 18)).select("x")) == \
        [(1.0,), (None,)]
    assert rows(filter_rows(df, date_col="d", date_before=D(2018, 9, 18)).select("s")) == [(1,)]
    assert rows(filter_rows(df, date_col="d", date_from=D(2018, 9, 18)).select("s")) == [(1,), (2,)]
    assert non_null_rows(df, "x").count() == 3


def test_having_and_drop_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    agg = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert rows(having(agg, F.col("n") > 1)) == [(1, 2)]
    assert rows(drop_duplicate_keys(df, ["k", "v"])) == [(1, "a"), (2, "b")]


def test_value_counts_within_top_k(spark):
    df = spark.createDataFrame([("X", r) for r in "aabbbc"] + [("Y", "z")], "country string, region string")
    out = rows(value_counts_within(df, "country", "region", k=2))
    assert out == [("X", "a", 2, 2), ("X", "b", 3, 1), ("Y", "z", 1, 1)]


def test_last_date_helpers(spark):
    df = _dated(spark)
    assert rows(last_date_per(df, "s", "d")) == [(1, D(2018, 9, 18)), (2, D(2018, 9, 19))]
    assert with_last_date(df, "s", "d").columns == ["s", "d", "x", "last_date"]
    assert with_last_date(df, "s", "d").where(F.col("last_date").isNull()).count() == 0


def test_global_quantiles_and_builtin_match(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 4, 2, 3, 9]], "v double")
    r = quantiles_long(df, [], ["v"], [0.5]).first()
    assert (r.q0, r.n) == (3.5, 6)
    a = group_quantiles(df, [], ["v"], 0.25, "p_").first()[0]
    b = group_quantiles(df, [], ["v"], 0.25, "p_", method="builtin").first()[0]
    assert a == b == 2.25


def test_partitioned_parquet_and_csv_sinks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, g string")
    p = scratch_path(spark, "sink", uuid.uuid4().hex)
    write_parquet(df, p, partition_by=["g"])
    back = read_parquet(spark, p)
    assert rows(back.where("g = 'a'").select("id")) == [(1,), (3,)]
    c = scratch_path(spark, "sink_csv", uuid.uuid4().hex)
    write_csv(df, c)
    assert spark.read.option("header", "true").csv(c).count() == 3


def test_maybe_broadcast_hint_only_when_bounded(spark):
    small = spark.range(5)
    big_plan = small.join(maybe_broadcast(small.withColumnRenamed("id", "k"), 10), F.col("id") == F.col("k"))
    assert "broadcast" in big_plan._jdf.queryExecution().logical().toString().lower()
    unhinted = maybe_broadcast(small, 2)
    assert unhinted is small
