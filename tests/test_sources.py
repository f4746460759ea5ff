"""Inferred scans with bad rows, typed bulk loads, bound values, clustered stages, fanned-out dimensions."""

import datetime as dt
import uuid

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_spark import operators as ops
from campaign_spark.session import scratch_path
from campaign_spark.sources import (
    inferred_profile, load_csv_table, materialize, read_csv_inferred, register, run_sql, write_parquet,
)


@pytest.fixture
def folder(spark):
    return lambda *parts: scratch_path(spark, "sources_test", uuid.uuid4().hex, *parts)


def _lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_inferred_scan_keeps_bad_lines(spark, folder):
    path = _lines(spark, folder(), ["id,day,amount,name", "1,2020-01-02,1.5,a", "2,2020-01-03,,b", "3,2020-01-04,2.0,c,too much",
                                    "4", "5,2020-01-05,7,"])
    df = read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "date", "double", "string", "string"]
    assert sorted(r._corrupt_record for r in df.collect() if r._corrupt_record) == ["3,2020-01-04,2.0,c,too much", "4"]
    got = {r.column_name: (r.inferred_type, r.n_values, r.n_bad_rows) for r in inferred_profile(df).collect()}
    assert got == {"id": ("int", 3, 2), "day": ("date", 3, 2), "amount": ("double", 2, 2), "name": ("string", 2, 2)}
    empty = read_csv_inferred(spark, _lines(spark, folder(), ["id,name"]))
    assert [tuple(r) for r in inferred_profile(empty).collect()] == [("id", "string", 0, 0), ("name", "string", 0, 0)]


def test_bulk_load_replaces_and_fails_fast(spark, folder):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType())])
    table = "load_" + uuid.uuid4().hex
    load_csv_table(spark, _lines(spark, folder(), ["id,day", "1,2020-01-02", "2,"]), schema, table, folder("a"))
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, dt.date(2020, 1, 2)), (2, None)]
    load_csv_table(spark, _lines(spark, folder(), ["id,day", "9,2021-01-02"]), schema, table, folder("b"))
    assert [r.id for r in spark.table(table).collect()] == [9]
    assert spark.table(table).schema == schema
    with pytest.raises((PySparkException, Py4JJavaError)):
        load_csv_table(spark, _lines(spark, folder(), ["id,day", "1,2020-01-02", "x,2020-01-02"]), schema, table, folder("c"))
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_bound_values_stay_values(spark):
    register({"bound_rows": spark.createDataFrame([("a", 1), ("a' OR '1'='1", 2)], "name string, n int")})
    query = "SELECT n FROM bound_rows WHERE name = :name AND n >= :least"
    assert [r.n for r in run_sql(spark, query, {"name": "a' OR '1'='1", "least": 0}).collect()] == [2]
    assert run_sql(spark, query, {"name": "a", "least": 2}).collect() == []
    with pytest.raises(PySparkException):
        run_sql(spark, query, {"name": "a"}).collect()


def _scanned_rows(df) -> int:
    """Rows that the file scan gave out when ``df`` ran: those of the row groups that were read."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan"):
            rows += node.metrics().get("numOutputRows").get().value()
        else:
            todo += [node.children().apply(i) for i in range(node.children().length())]
    return rows


def test_clustered_stage_skips_other_strategies(spark, folder):
    n = 20_000
    df = spark.range(n).select((F.col("id") * 7919 % 50).alias("strategy_id"), F.col("id").alias("order_key"),
                               F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 300).cast("int")).alias("captured_date"))
    plain, clustered = folder(), folder()
    write_parquet(df.repartition(8), plain)
    write_parquet(df, clustered, cluster_by=["strategy_id", "captured_date", "order_key"], clusters=8)
    one = lambda path: ops.filter_rows(spark.read.parquet(path), equals={"strategy_id": 3})
    assert one(plain).count() == one(clustered).count() == n / 50
    assert _scanned_rows(one(plain)) == n
    assert _scanned_rows(one(clustered)) <= n / 4  # at most two of eight ranges hold the strategy
    stage = materialize(spark, lambda: df, folder(), cluster_by=["strategy_id", "captured_date"])
    assert stage.count() == n


def test_a_hot_strategy_is_cut_into_ranges(spark, folder):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, 3).otherwise(F.col("id") % 40).alias("strategy_id"), F.col("id").alias("order_key"))
    path = folder()
    write_parquet(df, path, cluster_by=["strategy_id", "order_key"], clusters=9)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 9 and max(sizes) < 2_000


def test_duplicate_dimension_ids_fan_out(spark):
    fact = spark.createDataFrame([(1, 2.0), (2, 3.0), (None, 4.0), (9, 5.0)], "k int, x double")
    dim = spark.createDataFrame([(1, "one"), (1, "uno"), (2, "two")], "id int, label string")
    wide = ops.star_join(fact, [ops.Dimension(dim, "k", "id", {"label": "label"})])
    assert sorted(map(str, map(tuple, wide.select("k", "x", "label").collect()))) == sorted(map(str, [
        (1, 2.0, "one"), (1, 2.0, "uno"), (2, 3.0, "two"), (None, 4.0, None), (9, 5.0, None)]))
