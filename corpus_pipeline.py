"""The corpus pipeline: five operators, each stage written as Parquet and read by the next.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_spark.llm.common import cut, table
from campaign_spark.llm.mixing import mixed_documents
from campaign_spark.llm.near_dup import near_groups
from campaign_spark.llm.packing import pack
from campaign_spark.llm.quality import keep_good
from campaign_spark.llm.suffix_dedup import drop_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return keep_good(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays; of rows with
    one doc_id and text, all that its group keeps."""
    kept = near_groups(docs).filter("kept").select("doc_id").distinct()
    rows = docs.select(*COLUMNS)
    return rows.join(kept, "doc_id", "left_semi").union(rows.filter("doc_id is null"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that repeat are cut out of the texts."""
    return drop_repeats(docs.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of small sources are repeated to their weights; no row is lost."""
    return mixed_documents(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [("quality_rules", quality), ("minhash_near_dedup", near_dedup), ("suffix_array_dedup", suffix_dedup),
          ("mixing_sources", mixing), ("best_fit_packing", packing)]

# Banding, the merges and the packing plan have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
