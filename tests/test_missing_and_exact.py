"""Nothing is rounded away, NaN is missing, a stored 'NA' and NULL are one label, stages are whole."""

import uuid

import pytest

from campaign_spark.operators.aggregates import efficiency_by, totals_by
from campaign_spark.operators.impute import impute_group_median
from campaign_spark.operators.profile import group_distinct_counts, group_value_histogram, numeric_profile
from campaign_spark.operators.windows import distinct_value_counts, value_counts, value_counts_within
from campaign_spark.plans.popularity import run_popularity
from campaign_spark.session import scratch_path
from campaign_spark.sources.sinks import write_parquet
from campaign_spark.sources.stages import input_key, materialize


def test_small_spend_is_kept(spark):
    df = spark.createDataFrame([("a", 0.00004, 1.0, 1.0, 1.0)] * 10,
                               "country string, total_spend_cpm double, impressions double, clicks double, conversions double")
    row = efficiency_by(df, "country", ["impressions", "clicks", "conversions"]).first()
    assert row.total_spend_cpm == pytest.approx(0.0004) and row.im_cpm == pytest.approx(25000)
    with pytest.raises(Exception, match="multiple"):
        efficiency_by(df, "country", ["impressions", "clicks", "conversions"], exact={"total_spend_cpm": 4}).collect()


def test_profile_is_not_rounded(spark):
    row = numeric_profile(spark.createDataFrame([(1e-10,), (3e-10,)], "x double"), ["x"]).first()
    assert row["mean"] == pytest.approx(2e-10) and row["std"] > 0


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", "r", 1.0), ("a", "r", 3.0), ("a", "r", float("nan"))], "country string, region string, v double")
    assert totals_by(df, ["country"], ["v"]).first().v == 4.0
    filled = impute_group_median(df, ["country", "region"], ["v"])
    assert sorted(r.v for r in filled.collect()) == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("chunk", [None, 2])
def test_stored_na_and_null_are_one_label(spark, chunk):
    df = spark.createDataFrame([("g", "NA"), ("g", "NA"), ("g", None), ("g", "b")], "k string, v string")
    row = group_value_histogram(df, ["k"], "v", chunk_size=chunk).first()
    assert (row.v_counts, row.v_distinct) == ("NA: 3;; b: 1", 2)
    assert group_distinct_counts(df, ["k"], ["v"]).first().v_distinct == 2
    assert {(r.v, r.n_counts) for r in value_counts_within(df, "k", "v").collect()} == {("NA", 3), ("b", 1)}
    assert {(r.value, r.n_counts) for r in value_counts(df, ["v"]).collect()} == {("NA", 3), ("b", 1)}
    assert distinct_value_counts(df, ["v"]).first().n_distinct == 2


def test_stage_left_over_is_not_read(spark):
    path = scratch_path(spark, "stage_test", uuid.uuid4().hex)
    spark.range(2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/attempt-0")
    assert materialize(spark, lambda: spark.range(5), path).count() == 5
    write_parquet(spark.range(5), f"{path}/attempt-zz")  # a second builder's whole result
    assert materialize(spark, lambda: spark.range(9), path).count() == 5


def test_stage_is_of_its_input(spark):
    items = spark.createDataFrame([(1, "t", "g")], "movie_id long, title string, genres string")
    rate = lambda n: spark.createDataFrame([(u, 1, 4.0) for u in range(n)], "user_id long, movie_id long, rating double")
    assert run_popularity(spark, rate(1), items)["items"].first().popularity == 1
    assert run_popularity(spark, rate(3), items)["items"].first().popularity == 3
    a, b = (scratch_path(spark, uuid.uuid4().hex, "t.parquet") for _ in range(2))
    spark.range(1).write.parquet(a)
    spark.range(1).write.parquet(b)
    assert input_key(spark, [a]) != input_key(spark, [b]) and input_key(spark, [a]) == input_key(spark, [a])
