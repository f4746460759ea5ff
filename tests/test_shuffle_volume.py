"""Rows stay where they are when a small table per group is attached to them; a histogram is counted once."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from campaign_spark import operators as ops


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_broadcasts(spark):
    """A bound on broadcasts far above the tables per group and far below the rows."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, 20_000)
    yield
    spark.conf.set(name, before)


def _rows(spark):
    return spark.range(20_000).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"), F.lit("r").alias("r"),
        F.expr("date_add(date'2020-01-01', cast(id % 7 as int))").alias("day"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("double")).alias("v"))


def test_rows_are_not_shuffled_for_their_last_date(spark, small_broadcasts):
    rows = _rows(spark)
    before, on = ops.split_on_last_date(rows, "k", "day")
    for part in (before, on, ops.union_all([before, on])):
        assert "BroadcastHashJoin" in _plan(part)
        assert not re.search("SortMergeJoin|ShuffledHashJoin|Exchange hashpartitioning", _plan(part))
    assert before.count() + on.count() == 20_000
    # Three keys of four have the last day; rows without a key have none and come before.
    assert {r.last_date for r in on.select("last_date").distinct().collect()} == {dt.date(2020, 1, 7)}
    assert before.filter("k is null").count() == 5_000


def test_rows_are_not_shuffled_for_their_median(spark, small_broadcasts):
    out = ops.impute_group_median(_rows(spark), ["k", "r"], ["v"])
    assert "BroadcastHashJoin" in _plan(out)
    assert not re.search("SortMergeJoin|ShuffledHashJoin|Exchange hashpartitioning", _plan(out))
    assert out.count() == 20_000 and out.filter("v is null and k is not null").count() == 0


def test_a_histogram_of_dates_is_not_counted_again_by_label(spark):
    rows = spark.createDataFrame([(1, dt.date(2020, 1, 2), "NA"), (1, None, None), (1, dt.date(2020, 1, 2), None), (2, None, "a"),
                                  (None, None, "a")], "k long, day date, s string")
    by_day = ops.group_value_histogram(rows, ["k"], "day")
    assert _plan(by_day).count("Exchange hashpartitioning") == 2
    assert sorted(map(tuple, by_day.collect())) == [(1, 2, "2020-01-02: 2;; NA: 1"), (2, 1, "NA: 1")]
    # A stored 'NA' and NULL stay one label.
    assert sorted(map(tuple, ops.group_value_histogram(rows, ["k"], "s").collect())) == [(1, 1, "NA: 3"), (2, 1, "a: 1")]
