"""Session construction and the shared scratch location.

Every job in this package expects a session with AQE on (runtime join
re-planning, partition coalescing, skew-join splitting). Scratch output
(stage tables, round-trip files) always goes under the folder the cluster
names in ``spark.checkpoint.dir``. A private folder is created only when the
setting is absent on a local-mode session (tests); on a cluster the setting
is required.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied when this package builds the session itself. A session
# handed in by a cluster launcher keeps its own values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "campaign_spark",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with this package's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect
        pass
    ensure_checkpoint_dir(spark)
    return spark


_PRIVATE_DIRS: dict[int, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no JVM context on the client
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        if not str(spark.conf.get("spark.master", "local")).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        if id(spark) not in _PRIVATE_DIRS:
            _PRIVATE_DIRS[id(spark)] = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        return _PRIVATE_DIRS[id(spark)]
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder is invisible to other executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # Local mode only (tests, single-machine runs): a private folder.
        configured = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (never a machine-local temp dir)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "campaign_spark", *parts])
