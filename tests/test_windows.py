import datetime as dt

from pyspark.sql import functions as F

from campaign_spark.operators import running_totals, value_counts, value_counts_within

D = dt.date


def _running(spark, data):
    df = spark.createDataFrame(data, "ch string, rg string, d date, t int, x double")
    out = running_totals(df, ["ch", "rg"], "d", ["x"], tiebreak=["t"])
    return {(r.ch, r.rg, r.t): r.x_cumul for r in out.collect()}


def test_running_sum_null_row_and_continuation(spark):
    got = _running(spark, [
        ("c", "r", D(2020, 1, 1), 1, 1.0),
        ("c", "r", D(2020, 1, 2), 2, None),   # null in -> null out
        ("c", "r", D(2020, 1, 3), 3, 2.0),    # continues from 1.0
        ("c", "r", None, 4, 5.0),             # null date sorts last
        ("c", "q", D(2020, 1, 1), 5, 7.0),
        (None, "r", D(2020, 1, 1), 6, 1.0),   # null key: dropped
    ])
    assert got == {("c", "r", 1): 1.0, ("c", "r", 2): None, ("c", "r", 3): 3.0, ("c", "r", 4): 8.0,
                   ("c", "q", 5): 7.0}


def test_running_sum_ties_follow_tiebreak(spark):
    got = _running(spark, [
        ("c", "r", D(2020, 1, 1), 3, 1.0),
        ("c", "r", D(2020, 1, 1), 1, 10.0),
        ("c", "r", D(2020, 1, 1), 2, 100.0),
        ("c", "r", D(2020, 1, 2), 0, 1000.0),
    ])
    assert got == {("c", "r", 1): 10.0, ("c", "r", 2): 110.0, ("c", "r", 3): 111.0, ("c", "r", 0): 1111.0}


def test_last_running_total_equals_group_sum(spark):
    data = [("c", "r", D(2020, 1, 1 + i % 5), i, float(i)) for i in range(40)]
    df = spark.createDataFrame(data, "ch string, rg string, d date, t int, x double")
    out = running_totals(df, ["ch", "rg"], "d", ["x"], tiebreak=["t"])
    assert out.agg(F.max("x_cumul")).first()[0] == sum(range(40))


def test_running_sum_decimal_measure(spark):
    df = spark.createDataFrame([("c", "r", D(2020, 1, 1), 1, 0.1), ("c", "r", D(2020, 1, 2), 2, 0.2)],
                               "ch string, rg string, d date, t int, x double")
    df = df.withColumn("x", F.col("x").cast("decimal(18,4)"))
    out = running_totals(df, ["ch", "rg"], "d", ["x"], tiebreak=["t"]).orderBy("t")
    assert [float(r.x_cumul) for r in out.collect()] == [0.1, 0.3]


def test_value_counts_top_k_with_na_and_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", None), (None, 2), ("c", 2)], "s string, n int")
    out = value_counts(df, ["s", "n"], k=2).collect()
    got = {(r.column, r.rank): (r.value, r.n_counts) for r in out}
    assert got[("s", 1)] == ("b", 2)
    assert got[("s", 2)] == ("NA", 1)  # ties broken by value: 'NA' < 'a' < 'c'
    assert got[("n", 1)] == ("1", 2) and got[("n", 2)] == ("2", 2)
    assert len(out) == 4


def test_value_counts_within_drops_null_group(spark):
    df = spark.createDataFrame([("X", "r1"), ("X", None), ("X", "r1"), (None, "r2")], "country string, region string")
    out = {(r.country, r.region): (r.n_counts, r.rank) for r in value_counts_within(df, "country", "region").collect()}
    assert out == {("X", "r1"): (2, 1), ("X", "NA"): (1, 2)}


def test_sub_blocks_give_the_same_running_totals(spark):
    import random

    rnd = random.Random(11)
    data = []
    for i in range(300):
        d = None if i % 41 == 0 else D(2020, 1, 1 + rnd.randint(0, 2))
        t = None if i % 53 == 0 else rnd.randint(0, 50)
        x = None if i % 17 == 0 else float(rnd.randint(0, 9))
        data.append((rnd.choice(["c", "e"]), "r", d, t, i, x))
    df = spark.createDataFrame(data, "ch string, rg string, d date, t int, u int, x double")
    base = running_totals(df, ["ch", "rg"], "d", ["x"], tiebreak=["t", "u"])
    split = running_totals(df, ["ch", "rg"], "d", ["x"], tiebreak=["t", "u"], sub_blocks=4)
    a = {r.u: r.x_cumul for r in base.collect()}
    b = {r.u: r.x_cumul for r in split.collect()}
    assert a == b and len(a) == 300


def test_full_ranking_matches_row_number(spark):
    import random

    from pyspark.sql import Window

    rnd = random.Random(5)
    words = ["", "a", "ab", "abc", "b", "ba", "é", "zz", "longer-value-1", "longer-value-2", "Ä"]
    data = [(rnd.choice(["X", "Y"]), rnd.choice(words + [None])) for _ in range(400)]
    df = spark.createDataFrame(data, "country string, region string")
    got = {(r.country, r.region): r.rank for r in value_counts_within(df, "country", "region").collect()}
    counts = value_counts_within(df, "country", "region", k=10**6)
    assert got == {(r.country, r.region): r.rank for r in counts.collect()}


def test_full_ranking_keeps_null_group_when_asked(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), ("X", "c")], "country string, region string")
    out = {(r.country, r.region): r.rank for r in value_counts_within(df, "country", "region",
                                                                      drop_null_by=False).collect()}
    assert out == {(None, "a"): 1, (None, "b"): 2, ("X", "c"): 1}
