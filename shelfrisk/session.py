"""Session helpers: a tuned local session for tests/bench, and the shared
scratch location taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "shelfrisk") -> SparkSession:
    """Session used by tests and bench.  On a cluster the submitter owns the
    session; the library only reads its settings."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Runtime settings every job of the library relies on.

    AQE re-plans joins from real shuffle sizes (broadcast only when the
    materialised side is under the threshold, sort-merge otherwise) and splits
    skewed partitions of the preserved side of a join.  A write that is
    partitioned by a column of few values (a record's state) keeps that many
    files open instead of sorting its rows first; with more values it sorts.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "3")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's
    ``spark.checkpoint.dir``.  Only where that is unset and the session is
    local (tests) is a fresh local folder made; a cluster without it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not root and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared scratch root."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/shelfrisk/{name}-{uuid.uuid4().hex[:12]}"
