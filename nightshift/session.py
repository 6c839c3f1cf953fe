"""Session helpers: a local session for tests and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests, bench and the CLI when no session exists."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("nightshift")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("NIGHTSHIFT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, the shared scratch root.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
    used as is.  Only a local-mode session without the setting (tests, the
    driver's smoke run) gets a private folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="nightshift-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared scratch root (next to the checkpoint data)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    # The checkpoint dir is <configured>/<uuid>; keep our files beside it.
    return "/".join([root, "nightshift", *parts])


def materialize(df):
    """Write ``df`` once to the shared scratch folder and read it back.

    Used for per-batch relations that a program reads several times (the
    de-duplicated stage, a monthly delta, the changes of a merge): they are
    computed once, readers take only their columns, the planner knows their
    size, and a lost executor re-reads files instead of recomputing.
    """
    path = scratch_path(df.sparkSession, "work", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
