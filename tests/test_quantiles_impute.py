import random

import numpy as np
import pytest

from campaign_spark.operators import cleanse, group_medians, impute_group_median, quantiles_long
from tests.conftest import rows


def test_even_sized_median_interpolates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 10.0), ("a", 20.0), ("b", 5.0)], "k string, v double")
    out = dict((r.k, r.median_v) for r in group_medians(df, ["k"], ["v"]).collect())
    assert out == {"a": 6.0, "b": 5.0}


@pytest.mark.parametrize("method", ["bucketed", "window", "builtin"])
def test_medians_match_numpy_with_nulls_and_duplicates(spark, method):
    rnd = random.Random(7)
    data = []
    for g in range(6):
        for _ in range(rnd.randint(1, 40)):
            v = rnd.choice([None, float(rnd.randint(0, 5)), rnd.random() * 100])
            data.append((f"g{g}", v, rnd.choice([None, float(rnd.randint(0, 9))])))
    df = spark.createDataFrame(data, "k string, a double, b double")
    got = {r.k: (r.median_a, r.median_b) for r in group_medians(df, ["k"], ["a", "b"], method=method).collect()}
    for g in {d[0] for d in data}:
        for i, col in ((0, 1), (1, 2)):
            vals = [d[col] for d in data if d[0] == g and d[col] is not None]
            exp = float(np.median(vals)) if vals else None
            assert (got[g][i] is None and exp is None) or abs(got[g][i] - exp) < 1e-9


def test_quartiles_match_numpy_linear(spark):
    rnd = random.Random(3)
    vals = [rnd.randint(0, 50) * 0.5 for _ in range(101)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = quantiles_long(df, [], ["v"], [0.25, 0.5, 0.75]).collect()[0]
    assert [r.q0, r.q1, r.q2] == pytest.approx(list(np.percentile(vals, [25, 50, 75])))
    assert r.n == 101


@pytest.mark.parametrize("buckets", [1, 2, 3, 7, 64])
def test_bucketed_quantiles_exact_for_any_bucket_count(spark, buckets):
    rnd = random.Random(buckets)
    data = []
    for g in range(4):
        size = [1, 2, 57, 400][g]
        for _ in range(size):
            data.append((g, rnd.choice([float(rnd.randint(0, 30)), rnd.gauss(0, 100)])))
    df = spark.createDataFrame(data, "g int, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: [r.q0, r.q1, r.q2, r.q3, r.q4]
           for r in quantiles_long(df, ["g"], ["v"], probs, buckets=buckets).collect()}
    for g in range(4):
        vals = [v for k, v in data if k == g]
        assert got[g] == pytest.approx(list(np.percentile(vals, [p * 100 for p in probs])), abs=1e-9)


def test_null_key_rows_are_not_imputed(spark):
    df = spark.createDataFrame(
        [("A", "r", 1.0), ("A", "r", 3.0), ("A", "r", None), (None, "r", None), ("B", "s", None)],
        "country string, region string, impressions double",
    )
    out = rows(impute_group_median(df, ["country", "region"], ["impressions"]))
    assert out == [
        ("A", "r", 1.0, 2.0), ("A", "r", 2.0, 2.0), ("A", "r", 3.0, 2.0),
        ("B", "s", None, None), (None, "r", None, None),
    ]


def test_cleanse_constants_and_int_goal_type(spark):
    df = spark.createDataFrame(
        [("A", "r", None, 1.0, 2.0, None), ("A", "r", 2.0, None, None, 4.0)],
        "country string, region string, goal_type double, impressions double, clicks double, conversions double",
    )
    out = cleanse(df).orderBy("impressions").collect()
    assert [r.goal_type for r in out] == [3, 2]
    assert dict(out[0].asDict())["conversions"] == 1.0
    assert [r.impressions for r in out] == [1.0, 1.0]
    assert [r.clicks for r in out] == [2.0, 2.0]
    assert out[0].median_clicks == 2.0
    assert cleanse(df).schema["goal_type"].dataType.simpleString() == "int"
