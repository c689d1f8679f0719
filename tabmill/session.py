"""Session helpers: building a session for tests/bench and finding shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tabmill") -> SparkSession:
    """Session for tests and the benchmark.  On a cluster, use the cluster's own session."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TABMILL_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    Only a local-mode session (tests) may fall back to a fresh temporary folder; a
    cluster session without a configured shared folder is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master == "local" or sc.master.startswith("local["):  # not local-cluster: its executors share no folder
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabmill-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tabmill-scratch/{name}-{uuid.uuid4().hex}"
