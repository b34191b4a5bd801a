"""Session helpers: a local session for tests/bench, and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cinderframe",
                  event_log_dir: str | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    """A local session configured like the cluster one (UTC, AQE on, no UI).

    ``checkpoint_dir`` stands in for the cluster's shared folder (``spark.checkpoint.dir``,
    a static setting, so it is fixed when the session starts)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config(_CHECKPOINT_KEY, checkpoint_dir)
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names shared storage and is read, never overridden.  Only in
    a local session without it is a fresh folder created and registered; anywhere else its
    absence is an error, because executors could not read a folder of the driver.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no SparkContext handle
        sc = None
    path = spark.conf.get(_CHECKPOINT_KEY, None)
    if not path and sc is not None:
        path = sc.getConf().get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not path:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cinderframe-ckpt-")
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique table location under the shared folder."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
