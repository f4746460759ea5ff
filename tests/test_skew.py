"""Hot-key inputs: one group holds most rows. Results must stay exact."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from campaign_spark.operators import group_medians, running_totals, totals_by, value_counts_within


def _skewed(spark, n=3000):
    rnd = random.Random(17)
    data = []
    for i in range(n):
        hot = i % 3 != 0  # two thirds of all rows in one market
        country, region = ("ID", "Jakarta") if hot else (rnd.choice(["AU", "NZ"]), rnd.choice(["a", "b"]))
        day = dt.date(2020, 1, 1) + dt.timedelta(days=0 if hot and i % 2 else rnd.randint(0, 4))
        data.append((country, region, day, i, rnd.choice([None, float(rnd.randint(0, 500)), rnd.random()])))
    return spark.createDataFrame(data, "country string, region string, d date, t int, x double"), data


def test_hot_market_median_and_totals_exact(spark):
    df, data = _skewed(spark)
    med = {(r.country, r.region): r.median_x for r in group_medians(df, ["country", "region"], ["x"]).collect()}
    hot = [x for c, g, _, _, x in data if (c, g) == ("ID", "Jakarta") and x is not None]
    assert med[("ID", "Jakarta")] == float(np.median(hot))
    tot = {r.country: r.x for r in totals_by(df, ["country"], ["x"]).collect()}
    assert abs(tot["ID"] - sum(hot)) < 1e-6


def test_hot_day_running_totals_exact(spark):
    df, data = _skewed(spark)
    for sub in (None, 6):
        out = running_totals(df, ["country", "region"], "d", ["x"], tiebreak=["t"], sub_blocks=sub)
        got = {r.t: r.x_cumul for r in out.where((F.col("country") == "ID")).collect()}
        rows = sorted((d, t, x) for c, g, d, t, x in data if c == "ID")
        acc = 0.0
        for d, t, x in rows:
            if x is None:
                assert got[t] is None
            else:
                acc += x
                assert abs(got[t] - acc) < 1e-6


def test_hot_group_full_ranking_exact(spark):
    rnd = random.Random(3)
    data = [("HOT", f"v{rnd.randint(0, 400)}") for _ in range(4000)] + [("cold", "a"), ("cold", "b")]
    df = spark.createDataFrame(data, "country string, region string")
    got = {(r.country, r.region): r.rank for r in value_counts_within(df, "country", "region").collect()}
    exp = {(r.country, r.region): r.rank for r in value_counts_within(df, "country", "region", k=10**6).collect()}
    assert got == exp
