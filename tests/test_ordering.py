"""Ranges of the whole sort key: ranks, sorted files and their re-read, quantiles from one source of boundaries."""

import random
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_spark import operators as ops
from campaign_spark.operators.ordering import AT, BLOCK, in_order, ranked
from campaign_spark.session import scratch_path
from campaign_spark.sources import first_rows, read_in_order, result_files, write_sorted_csv


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_match_a_sort_with_nulls_and_ties(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([1.0, 2.0, None]), k) for k in range(500)] + [("one", 1.0, 999)]
    df = spark.createDataFrame(data, "g string, x double, k int").repartition(5)
    for n in (None, 1, 3, 7):
        got = {(r.g, r.k): r["rank"] for r in ranked(df, ["g"], [F.desc("x"), "k"], partitions=n).collect()}
        want = {}
        for g in {d[0] for d in data}:
            mine = sorted((d for d in data if d[0] == g), key=lambda d: (d[1] is None, -(d[1] or 0), d[2]))
            want.update({(g, d[2]): i + 1 for i, d in enumerate(mine)})
        assert got == want
    assert ranked(df.limit(0), ["g"], ["x", "k"]).count() == 0


def test_values_of_one_count_and_one_start_are_spread(spark):
    """200,000 values of one group, each once, with a common start of 30 bytes: many ranges, exact ranks."""
    start = "https://www.example.com/common/"
    df = spark.range(200_000).select(F.lit("HOT").alias("part"), F.concat(F.lit(start), F.lpad(F.col("id").cast("string"), 7, "0")).alias("value"),
                                     F.lit(1).cast("long").alias("n_counts"))
    sizes = [r["count"] for r in in_order(df, ["part", F.desc("n_counts"), "value"], "skew", 16).groupBy(BLOCK).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 200_000 / 16
    out = ops.windows.rank_within(df.repartition(8), ["part"], None)
    assert out.filter(F.col("rank") != F.substring("value", len(start) + 1, 7).cast("long") + 1).count() == 0
    assert out.count() == 200_000 and "SinglePartition" not in _plan(out)


def test_places_follow_the_order(spark):
    df = spark.range(1_000).select((F.col("id") * 7 % 1_000).alias("v"))
    got = in_order(df, ["v"], "places", 4).orderBy(BLOCK, AT).collect()
    assert [r.v for r in got] == list(range(1_000)) and len({r[BLOCK] for r in got}) == 4


@pytest.fixture(scope="module")
def result(spark):
    rnd = random.Random(8)
    rows = [(k, rnd.randrange(50), rnd.choice(["plain", "with, comma", 'with "quotes"', None])) for k in range(3_000)]
    df = spark.createDataFrame(rows, "item long, score int, name string").repartition(6)
    path = scratch_path(spark, "sorted_test", uuid.uuid4().hex)
    asked = write_sorted_csv(df, path, [F.desc("score"), "item"], rows_per_file=250)
    return df, path, asked, sorted(rows, key=lambda r: (-r[1], r[0]))


def test_sorted_files_read_by_name_are_the_sorted_result(spark, result):
    df, path, asked, want = result
    files = result_files(spark, path)
    assert asked == 12 and 8 <= len(files) <= 12
    got = []
    for f in files:  # plain text, file after file
        lines = spark.read.text(f).coalesce(1).collect()
        got += [int(r.value.split(",")[0]) for r in lines[1:]]
    assert got == [r[0] for r in want]


def test_read_in_order_and_first_rows(spark, result):
    df, path, _, want = result
    back = read_in_order(spark, path, df.schema)
    assert [tuple(r)[:3] for r in sorted(back.collect(), key=lambda r: r.position)] == want
    for n in (0, 1, 10, 600, 5_000):
        top = first_rows(spark, path, df.schema, n, "position").collect()
        assert [tuple(r) for r in sorted(top, key=lambda r: r.position)] == [(*w, i + 1) for i, w in enumerate(want[:n])]
    # Ten rows stand in the first file; no other is scanned.
    assert len(first_rows(spark, path, df.schema, 10).inputFiles()) == 1


def test_split_files_keep_their_order(spark, result):
    """One file read as several splits, dealt to several tasks."""
    df, _, _, want = result
    path = scratch_path(spark, "sorted_test", uuid.uuid4().hex)
    write_sorted_csv(df, path, [F.desc("score"), "item"])
    assert len(result_files(spark, path)) == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        back = read_in_order(spark, path, df.schema)
        assert [tuple(r)[:3] for r in sorted(back.collect(), key=lambda r: r.position)] == want
        assert [r.item for r in first_rows(spark, path, df.schema, 40).collect()] == [w[0] for w in want[:40]]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_writer_has_no_single_task(spark, result):
    df = result[0]
    plan = _plan(df.repartitionByRange(4, F.desc("score"), "item").sortWithinPartitions(F.desc("score"), "item"))
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


def test_quantiles_have_one_source_of_boundaries(spark):
    """The plan reads written ranges only: no sketch is evaluated, and results equal Spark's own with broadcast off."""
    rnd = random.Random(6)
    data = [(rnd.choice("abc") if k % 3 else "hot", rnd.choice([float(rnd.randint(0, 9)), rnd.gauss(0, 50), None])) for k in range(4_000)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mine = ops.group_medians(df, ["g"], ["v"])
        assert "percentile" not in _plan(mine)
        assert len({re.search(r"ordered/quantiles-[0-9a-f]+/", f).group() for f in mine.inputFiles()}) == 1
        assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, ops.group_medians(df, ["g"], ["v"], method="builtin").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    hot = [v for g, v in data if g == "hot" and v is not None]
    assert {r.g: r.median_v for r in mine.collect()}["hot"] == pytest.approx(float(np.median(hot)), abs=1e-12)


@pytest.mark.parametrize("chunk", [1, 2, 7, 1_000])
def test_text_of_a_large_group_is_a_tree(spark, chunk):
    data = [("big", f"v{k % 301}") for k in range(900)] + [("small", "x"), ("small", None), (None, "dropped")]
    df = spark.createDataFrame(data, "g string, v string")
    plain = sorted(map(tuple, ops.group_value_histogram(df, ["g"], "v").collect()))
    assert sorted(map(tuple, ops.group_value_histogram(df, ["g"], "v", chunk_size=chunk).collect())) == plain
    assert plain[0][1] == 301


def test_distinct_counts_have_no_expand(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "NA"), ("a", 2, "x"), (None, 3, "y"), ("b", None, None)], "g string, x int, y string")
    out = ops.group_distinct_counts(df, ["g"], ["x", "y"])
    assert "Expand" not in _plan(out)
    assert sorted(map(tuple, out.collect())) == [("a", 2, 2), ("b", 1, 1)]
