"""The Parquet event lake: conversion, reuse, partition discovery, consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schema import CORE_COLUMNS


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def write_complete(spark: SparkSession, path: str) -> bool:
    """A finished Spark write leaves ``_SUCCESS``; a partial one does not."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def write_lake(events: DataFrame, path: str, partition_by=("event_date",),
               max_records_per_file: int = 5_000_000, shuffle: bool = True) -> None:
    """Events → partitioned zstd Parquet.

    ``shuffle=True``: rows are range-partitioned on (partition columns, event
    time), so each task writes one or a few partition folders (few files), and
    a hot partition value (one day or one type holding a large share of the
    rows) is split over many tasks by time instead of landing in one task, as
    a hash repartition on the partition columns alone would do.  The range
    boundaries come from a sample, which reads the input once more.

    ``shuffle=False``: every input split writes its own rows (no shuffle, no
    extra read, balanced by the split size).  Best when the input is already
    in time order, as raw event files usually are; with unordered input each
    task writes one file per partition value it holds.
    """
    df = events
    if "event_date" in partition_by and "event_date" not in df.columns:
        df = df.withColumn("event_date", F.to_date("event_time"))
    if shuffle and partition_by:
        df = df.repartitionByRange(*[F.col(c) for c in partition_by], F.col("event_time"))
    (
        df.write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def load_or_create_lake(spark: SparkSession, source: DataFrame, path: str,
                        partition_by=("event_date",), shuffle: bool = True) -> DataFrame:
    """Reuse a finished lake, else convert ``source`` into it (idempotent)."""
    if not write_complete(spark, path):
        write_lake(source, path, partition_by, shuffle=shuffle)
    return read_lake(spark, path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Parquet lake with partition discovery; returns the 9 core columns."""
    return spark.read.parquet(path).select(*CORE_COLUMNS)


def read_lake_if_present(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """None only when the folder is missing or holds no data files."""
    if not path_exists(spark, path):
        return None
    try:
        df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    except AnalysisException as e:  # empty folder: unable to infer schema
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "Unable to infer schema" in str(e):
            return None
        raise
    return None if df.isEmpty() else df


def consolidate(baseline: DataFrame, streamed: DataFrame | None, dedup: str = "stream") -> DataFrame:
    """Baseline ∪ streamed archive.

    ``dedup='stream'`` (reference behaviour) removes full-row duplicates from
    the streamed side only; ``'all'`` de-duplicates the union; ``'none'`` keeps
    everything.  The de-duplication is a hash aggregate on all 9 columns with
    map-side combine, so replayed copies collapse before the shuffle.
    """
    base = baseline.select(*CORE_COLUMNS)
    if streamed is None:
        return base.dropDuplicates(CORE_COLUMNS) if dedup == "all" else base
    stream = streamed.select(*CORE_COLUMNS)
    if dedup == "stream":
        stream = stream.dropDuplicates(CORE_COLUMNS)
    out = base.unionByName(stream)
    return out.dropDuplicates(CORE_COLUMNS) if dedup == "all" else out
