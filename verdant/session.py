"""Session settings the operators rely on, and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan assumes.  Runtime SQL confs only: safe on a live session.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Only shuffles smaller than (cores x 1 MB) are affected: AQE then keeps up
    # to one task per core instead of coalescing a tiny but file-count-bound
    # partitioned write (e.g. 1,440 hourly folders) into a single writer.
    # Large shuffles are sized by the advisory partition size as before.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def ensure_session(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def build_session(master: str = "local[*]", app: str = "verdant", **conf) -> SparkSession:
    """Session for tests and local runs (a cluster supplies its own)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.sql.shuffle.partitions", "8"))
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only where it is unset on a local
    master (tests, a laptop) is a folder of our own chosen and registered; a
    cluster without a shared checkpoint folder is a configuration error,
    since a machine-local folder would not survive an executor loss.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(e.g. on HDFS or an object store)")
        root = tempfile.mkdtemp(prefix="verdant-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/verdant/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["ensure_session", "build_session", "checkpoint_root", "scratch_path"]
