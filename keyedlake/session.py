"""Session defaults and the shared scratch location.

Work that must outlive a task (streaming checkpoints, lake tables written by
the catalogue queries, lineage cuts) goes under the cluster's shared
``spark.checkpoint.dir``.  A local folder is only chosen when the session
names none, which is the case for unit tests on a laptop.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Writers persist the precombined batch; let AQE coalesce the shuffle
    # inside that cached plan instead of keeping shuffle.partitions tasks.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # Compaction / copy-on-write rewrites aim at ~128 MB files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "keyedlake",
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (set one only if it is unset)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        except Exception:  # pragma: no cover - conf access differs by mode
            root = None
    if not root:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            root = os.path.dirname(existing.rstrip("/"))
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not root:
        # Only for local runs without a configured shared folder (tests).
        root = tempfile.mkdtemp(prefix="keyedlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run."""
    return f"{shared_root(spark)}/keyedlake/{name}-{uuid.uuid4().hex[:12]}"
