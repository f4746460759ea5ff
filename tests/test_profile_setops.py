import datetime as dt

import pandas as pd
import pytest

from campaign_spark.operators import (
    code_compliance, distinct_values, group_distinct_counts, group_value_histogram, key_difference,
    null_coverage_gaps, numeric_profile, repeated_pairs, split_on_last_date, union_all,
)
from tests.conftest import rows

D = dt.date


def test_code_compliance_edge_cases(spark):
    df = spark.createDataFrame([("",), ("a-b",), ("a-b-",), (None,), ("x-y-z",), ("a-b",)], "c string")
    out = dict(rows(code_compliance(df, "c")))
    assert out == {"": 1, "a-b": 2, "compliant": 2}


def test_count_text_order_and_na(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, "z"), (None, "q")], "g int, v string")
    out = {r.g: (r.v_distinct, r.v_counts) for r in group_value_histogram(df, ["g"], "v").collect()}
    assert out == {1: (3, "b: 2;; NA: 1;; a: 1"), 2: (1, "z: 1")}


def test_count_text_dates(spark):
    df = spark.createDataFrame([(1, D(2018, 9, 18)), (1, D(2018, 9, 18)), (1, D(2018, 9, 1))], "g int, d date")
    assert group_value_histogram(df, ["g"], "d").first().d_counts == "2018-09-18: 2;; 2018-09-01: 1"


def test_distinct_counts_count_null_once(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "g int, v string")
    assert group_distinct_counts(df, ["g"], ["v"]).first().v_distinct == 2


def test_null_coverage_gaps_equals_except(spark):
    df = spark.createDataFrame(
        [("A", "r", None), ("A", "r", 1.0), ("B", "s", None), (None, None, None), (None, None, None), ("C", "t", 2.0)],
        "country string, region string, x double")
    gaps = rows(null_coverage_gaps(df, ["country", "region"], "x"))
    nulls = df.where("x IS NULL").select("country", "region")
    vals = df.where("x IS NOT NULL").select("country", "region")
    assert gaps == rows(key_difference(nulls, vals, ["country", "region"]))
    assert gaps == [("B", "s"), (None, None)]


def test_numeric_profile_matches_pandas_describe(spark):
    vals = [1.0, 2.0, 2.0, 7.5, None, 10.0, 3.25]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = numeric_profile(df, ["x"]).first()
    d = pd.Series(vals, dtype="float64").describe()
    assert r["count"] == d["count"] and r["n_null"] == 1
    assert r["mean"] == pytest.approx(d["mean"]) and r["std"] == pytest.approx(d["std"])
    assert [r["min"], r["p25"], r["p50"], r["p75"], r["max"]] == pytest.approx(
        [d["min"], d["25%"], d["50%"], d["75%"], d["max"]])


def test_repeated_pairs_having(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "c string, d int")
    assert rows(repeated_pairs(df, ["c", "d"], 2)) == [("a", 1, 2)]


def test_split_on_last_date_parts_add_up(spark):
    df = spark.createDataFrame(
        [(1, D(2020, 1, 1)), (1, D(2020, 1, 5)), (1, None), (2, D(2020, 2, 2)), (None, D(2020, 1, 1)), (3, None)],
        "s int, d date")
    before, on = split_on_last_date(df, "s", "d")
    assert rows(on) == [(1, D(2020, 1, 5), D(2020, 1, 5)), (2, D(2020, 2, 2), D(2020, 2, 2))]
    assert before.count() + on.count() == df.count()
    assert rows(union_all([before, on]).select("s", "d")) == rows(df)


def test_distinct_values_na(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    assert rows(distinct_values(df, "c")) == [("NA",), ("a",)]


def test_chunked_count_text_equals_plain(spark):
    import random

    rnd = random.Random(9)
    data = [(rnd.randint(0, 3), rnd.choice([None, "a", "b", "c", "dd", "e", "ff", "g"])) for _ in range(300)]
    data += [(None, "x")]
    df = spark.createDataFrame(data, "g int, v string")
    plain = {r.g: (r.v_distinct, r.v_counts) for r in group_value_histogram(df, ["g"], "v").collect()}
    for size in (1, 2, 3, 100):
        chunked = {r.g: (r.v_distinct, r.v_counts)
                   for r in group_value_histogram(df, ["g"], "v", chunk_size=size).collect()}
        assert chunked == plain
