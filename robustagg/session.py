"""Session construction and lineage-cut storage.

Iterative operators (the greedy cover) cut their lineage with
``DataFrame.checkpoint()``, which writes to the directory the cluster names in
``spark.checkpoint.dir``. That setting is read from the session; a directory of
our own is only chosen when nothing is configured and Spark runs in local mode
(tests, benchmarks). On a cluster an unset directory is an error: a
machine-local folder would not survive the loss of an executor.
"""

from __future__ import annotations

import math
import os
import re
import tempfile

from pyspark.sql import SparkSession


PARTITION_BYTES = 256 * 1024 * 1024


def scale_conf(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Partitioning settings for an input of ``input_bytes``: scan splits and
    post-shuffle partitions of about ``partition_bytes`` (AQE coalesces small
    ones and splits skewed join partitions), so a task's share fits executor
    memory and spills rather than fails. 100 TB gives about 400,000 shuffle
    partitions of 256 MB."""
    parts = max(8, math.ceil(input_bytes / partition_bytes))
    size = str(partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Iterative operators checkpoint a new state every step; let the
        # context cleaner delete checkpoint files nothing refers to any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "robustagg", input_bytes: int | None = None) -> SparkSession:
    """A session with AQE on and the UI off (for tests, bench and examples).
    With ``input_bytes`` the partitioning follows ``scale_conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        for key, value in scale_conf(input_bytes).items():
            builder = builder.config(key, value)
        shuffle_partitions = int(scale_conf(input_bytes)["spark.sql.shuffle.partitions"])
    return (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it from the session
    configuration, or (local mode only, setting absent) from a fresh scratch
    folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster is a cluster
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a shared folder (HDFS, "
            "object store) for iterative operators on a cluster")
    path = tempfile.mkdtemp(prefix="robustagg-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
