"""Plan-shape checks that guard the scale design against regressions."""

import re

import pytest

from campaign_spark import operators as ops
from campaign_spark.plans import fixtures
from campaign_spark.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_python_and_no_nested_loop_joins(spark, name):
    plan = _plan(Q.QUERIES[name](spark, SF))
    assert not re.search(r"EvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF", plan)
    assert not re.search(r"NestedLoopJoin|CartesianProduct", plan)


def test_top_k_limits_before_the_shuffle(spark):
    plan = _plan(Q.QUERIES["top_values"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_key_and_strategy_filters_reach_the_scan(spark):
    plan = _plan(Q.QUERIES["strategy_running_totals"](spark, SF))
    assert "EqualTo(strategy_id,3)" in plan and "IsNotNull(channel_name)" in plan
    plan = _plan(Q.QUERIES["totals_by_country"](spark, SF))
    assert "PushedFilters: [IsNotNull(country)]" in plan


def test_star_join_prunes_dimension_columns(spark):
    plan = _plan(fixtures.campaign_joined(spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan
    assert "l_extendedprice" not in plan.split("ReadSchema: struct<l_orderkey")[1].split(">")[0]


def test_median_histogram_shuffle_is_keyed_by_value(spark):
    # The default method writes this histogram in order of the value; "window" shows its shuffle in one plan.
    plan = _plan(ops.group_medians(Q.joined(spark, SF), ["country", "region"], ["impressions", "clicks"], method="window"))
    assert re.search(r"hashpartitioning\(country#\d+, region#\d+, measure#\d+, value#\d+", plan)
