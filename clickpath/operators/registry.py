"""Model registry as an append-only log.

Each training cycle appends one row (``promoted`` says whether it became the
champion).  The active champion is the newest promoted row (``created_at``
then ``version`` descending), which is the state the reference reaches by
flipping ``is_active`` flags, without in-place updates.

Rows are numbered commits beside the registry folder (``PATH-commits``): the
next number has one winner, so of two cycles that decided against the same
champion the second is refused (:class:`CommitConflict`) and decides again.
Parquet rows in the folder itself, from before the commits, are read too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import REGISTRY_SCHEMA
from ..sources.commits import CommitConflict, latest_commit, write_commit
from ..sources.lake import read_lake_if_present

REGISTRY_COLUMNS = [f.name for f in REGISTRY_SCHEMA.fields]


def _newest():
    return [F.col("created_at").desc(), F.col("version").desc()]


def active_champion(log: DataFrame) -> DataFrame:
    """Newest promoted row, or no row."""
    return log.filter(F.col("promoted")).orderBy(*_newest()).limit(1)


def active_version(log: DataFrame) -> str | None:
    """The active champion's version (a scalar read of one aggregate row)."""
    return log.filter(F.col("promoted")).agg(
        F.max_by(F.col("version"), F.struct("created_at", "version"))
    ).first()[0]


def registry_state(log: DataFrame) -> DataFrame:
    """Every row with ``is_active`` derived and the number of models trained (two aggregates over metadata rows)."""
    everywhere = Window.partitionBy()  # one row per training cycle
    active = F.max_by(F.when(F.col("promoted"), F.col("version")),
                      F.when(F.col("promoted"), F.struct("created_at", "version"))).over(everywhere)
    return log.withColumn("is_active", F.coalesce(F.col("version") == active, F.lit(False))) \
        .withColumn("n_models", F.count(F.lit(1)).over(everywhere))


def registry_listing(log: DataFrame) -> DataFrame:
    """Newest first, with ``is_active`` and the version's short name (its first 8 characters)."""
    return registry_state(log).withColumn("short_version", F.substring("version", 1, 8)).orderBy(*_newest())


def registry_history(log: DataFrame) -> DataFrame:
    """Ascending by creation time, with the position of each row."""
    return log.orderBy("created_at", "version")


def commits_path(path: str) -> str:
    return path.rstrip("/") + "-commits"


def registry_version(spark: SparkSession, path: str) -> int:
    """Number of the newest commit: what a decision was based on."""
    return latest_commit(spark, commits_path(path))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    out = spark.createDataFrame([], REGISTRY_SCHEMA)
    old = read_lake_if_present(spark, path, merge_schema=True)
    if old is not None:
        # rows written before a column existed have null there
        out = out.unionByName(old.select(*[F.col(f.name) if f.name in old.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                           for f in REGISTRY_SCHEMA.fields]))
    if registry_version(spark, path):
        out = out.unionByName(spark.read.schema(REGISTRY_SCHEMA).json(commits_path(path)))
    return out


def append_registry(spark: SparkSession, path: str, *, hdfs_path: str, version: str, trained_on: str,
                    metrics: dict, promoted: bool, created_at: dt.datetime | None = None,
                    gap: str | None = None, distinct: str | None = None, features: list[str] | None = None,
                    expected: int | None = None, tries: int = 20) -> int:
    """Commit one cycle row; returns its number.

    ``expected``: the :func:`registry_version` that the decision was based on;
    :class:`CommitConflict` if another row came since.  Without it the row
    takes the next free number.
    """
    number = lambda k: float(metrics[k]) if metrics.get(k) is not None else None
    values = (
        hdfs_path, version, trained_on,
        *(number(k) for k in ("auc", "accuracy", "precision", "recall", "precision_purchase", "recall_purchase", "decision_threshold")),
        bool(promoted), (created_at or dt.datetime.now(dt.timezone.utc)).isoformat(),
        gap, distinct, ",".join(features) if features else None,
    )
    row = dict(zip(REGISTRY_COLUMNS, values))
    for _ in range(tries):
        n = registry_version(spark, path) if expected is None else expected
        try:
            write_commit(spark, commits_path(path), n + 1, row)
            return n + 1
        except CommitConflict:
            if expected is not None:
                raise
    raise CommitConflict(f"{path}: no free number in {tries} tries")
