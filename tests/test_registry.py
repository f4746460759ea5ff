"""Every registered query against its DuckDB SQL twin on the sf0.001 tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from campaign_spark.plans.oracle import ORACLE
from campaign_spark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.12g}")
    if type(v).__name__ == "date":
        return v.isoformat()
    return v


def _key(rows):
    return sorted(tuple((c is None, str(c)) for c in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "im_cpm" in df.columns


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = dict(zip(*(lambda r: (r.columns, [str(t) for t in r.types]))(duck.sql(ORACLE[name]))))
    assert spark_types == duck_types
    cols = sorted(df.columns)
    got = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    rel = duck.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert cols == sorted(dcols)
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    exp = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    assert len(got) == len(exp)
    assert _key(got) == _key(exp)
