"""Helpers shared by the operators: cut lineage, hash words, connected components."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_spark.session import scratch_path
from campaign_spark.sources.stages import hadoop_fs

_U = np.uint64
_CACHE_WORDS = 400_000  # words whose hash a Python worker keeps; memory only, no effect on results


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Later steps restart from these files when an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(done: DataFrame) -> None:
    """Delete the files of a ``cut`` that no later step reads: all that was made from it is written itself."""
    files = done.inputFiles()
    if files:
        fs, path = hadoop_fs(done.sparkSession, files[0])
        fs.delete(path.getParent(), True)


def byte_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, body): whole texts as UTF-8 bytes, null as empty; other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))


class WordHash(dict):
    """word bytes -> 64-bit hash; emptied when full, so its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v): neighbours are re-attached to the smallest one."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(low, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(low.select("u", F.col("m").alias("v"))))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of ``edges`` (a, b).

    Union-find as a distributed job: large and small stars alternate until
    every node points at its root; a hot node's links are pre-aggregated
    (min) and its join is one that adaptive execution can split.
    """
    now = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct(), name)
    seen = None
    while True:
        now = cut(_stars(_stars(now, True), False), name)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .union(roots.select("node", F.col("node").alias("comp"))))
