"""Materialized stages: compute once, write Parquet, read back.

Writing a stage to the shared checkpoint folder and reading it back cuts the
lineage (a lost executor recomputes from the stage files, not from the raw
inputs) and lets later steps reuse it. The caller names the stage by its path.

Every build writes an attempt folder of its own below that path; an attempt is
committed by the ``_SUCCESS`` file that Spark's committer leaves last. Readers
take the first committed attempt by name, so nothing is renamed, left-overs of a
failed build are never read, and of two builds at once each is whole.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from campaign_spark.session import scratch_path
from campaign_spark.sources.sinks import write_parquet


def hadoop_fs(spark: SparkSession, path: str):
    """The cluster's Hadoop FileSystem for ``path``, and the path in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _committed(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_fs(spark, path.rstrip("/"))
    if not fs.exists(p):
        return None
    names = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())
    for name in names:
        attempt = f"{path.rstrip('/')}/{name}"
        if name.startswith("attempt-") and fs.exists(hadoop_fs(spark, attempt + "/_SUCCESS")[1]):
            return attempt
    return None


def stage_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a committed stage."""
    return _committed(spark, path) is not None


def materialize(spark: SparkSession, build: Callable[[], DataFrame], path: str,
                refresh: bool = False, cluster_by: list[str] | None = None) -> DataFrame:
    """Read the stage at ``path`` if committed, else build, write (clustered by ``cluster_by``), re-read."""
    if refresh:
        fs, p = hadoop_fs(spark, path.rstrip("/"))
        if fs.exists(p):
            fs.delete(p, True)
    done = _committed(spark, path)
    if done is None:
        done = f"{path.rstrip('/')}/attempt-{uuid.uuid4().hex}"
        write_parquet(build(), done, cluster_by=cluster_by)
    return spark.read.parquet(done)


def input_key(spark: SparkSession, paths: list[str]) -> str:
    """A name for the present content of ``paths``: exact paths, and their files' sizes and times."""
    seen = []
    for path in paths:
        fs, p = hadoop_fs(spark, path)
        if fs.exists(p):
            found = [fs.getFileStatus(p)] if fs.getFileStatus(p).isFile() else list(fs.listStatus(p))
            seen += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found)
        else:
            seen.append((path, -1, -1))
    return hashlib.sha256(repr(seen).encode()).hexdigest()[:32]


def stage_path(spark: SparkSession, *parts: str) -> str:
    """Default stage location under the shared checkpoint folder."""
    return scratch_path(spark, "stages", *parts)
