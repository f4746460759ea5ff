import math

from pyspark.sql import functions as F

from campaign_spark.operators import efficiency_by, ratio_of_sums_by, totals_by, totals_by_sets, with_ratios
from tests.conftest import rows


def _camp(spark):
    return spark.createDataFrame(
        [
            ("A", "x", 1.0, 2.0, None, 0.10),
            ("A", "y", 3.0, None, 1.0, 0.20),
            (None, "x", 5.0, 1.0, 1.0, 0.30),   # null key: dropped from 'country'
            ("B", None, None, None, None, 0.0),  # all-null measures -> 0.0
        ],
        "country string, channel_name string, impressions double, clicks double, conversions double, "
        "total_spend_cpm double",
    )


def test_totals_drop_null_keys_and_all_null_sum_is_zero(spark):
    out = totals_by(_camp(spark), ["country"], ["impressions", "clicks", "conversions"])
    assert rows(out) == [("A", 4.0, 2.0, 1.0), ("B", 0.0, 0.0, 0.0)]


def test_totals_by_sets_equals_separate_totals(spark):
    df = _camp(spark)
    keys, ms = ["country", "channel_name"], ["impressions", "clicks"]
    sets = totals_by_sets(df, keys, ms)
    for k in keys:
        one = sets.where(F.col("breakdown") == k).select(F.col("key_value").alias(k), *ms)
        assert rows(one) == rows(totals_by(df, [k], ms))


def test_zero_denominator_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (1.0, None)], "a double, b double")
    out = [r.r for r in with_ratios(df, {"r": ("a", "b")}).collect()]
    assert out == [None, None, 1.5, None]


def test_efficiency_is_ratio_of_sums_with_exact_spend(spark):
    out = efficiency_by(_camp(spark), "country", ["impressions", "clicks", "conversions"],
                        exact={"total_spend_cpm": 4})
    a = [r for r in out.collect() if r.country == "A"][0]
    assert a.total_spend_cpm == 0.3  # 0.1 + 0.2 summed exactly
    assert math.isclose(a.im_cpm, 4.0 / 0.3)
    assert a.clicks_im == 0.5
    b = [r for r in out.collect() if r.country == "B"][0]
    assert b.im_cpm is None and b.conversions_clicks is None


def test_ratio_of_sums_by(spark):
    df = spark.createDataFrame([("d", 1.0, 2.0), ("d", 1.0, 2.0), ("e", 1.0, None)], "k string, s double, i double")
    out = {r.k: r.cpm for r in ratio_of_sums_by(df, ["k"], "s", "i", "cpm").collect()}
    assert out == {"d": 0.5, "e": None}
