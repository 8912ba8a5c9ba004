"""Session defaults and the shared work folder.

Every entry point calls :func:`prepare` once.  It pins the session time zone
to UTC (event times carry a literal ``UTC`` suffix, so parsing depends on the
session zone) and makes sure a reliable checkpoint folder exists.  The
checkpoint folder is read from the session (``spark.checkpoint.dir``); a
private one is created only when the cluster names none, as in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster, created only if unset."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set: name a folder on the cluster's shared file system")
        # Local mode only (tests, benchmarks): a private folder on this machine.
        configured = tempfile.mkdtemp(prefix="clickpath-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path for derived tables beside the checkpoint folder (same file system)."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "clickpath-work", *parts])


def local_session(app: str = "clickpath", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CLICKPATH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
