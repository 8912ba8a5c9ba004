"""Sink 2: closed sessions → active champion → predictions and counters.

* The feature definition is the shared one (``stream_session_features``):
  ``session_window`` per key with a watermark, append mode, so every session
  is emitted once, when the watermark passes its end (last event + gap).
* The champion is resolved once per micro-batch from the registry log (polled
  at most every ``poll_seconds``) and pinned for the whole batch; a failed
  load keeps the previous model.
* Writes are idempotent: predictions go to ``scored_date=…/run_id=…/batch_id=…``
  (the scoring time of a batch is pinned, see :mod:`.store`), per-batch counters
  and sessions the assembler cannot score to ``run_id=…/batch_id=…``, all with
  dynamic partition overwrite, so a retried batch replaces its own rows.
  Running counters are the rolled-up totals and the batches above them.
"""

from __future__ import annotations

import hashlib
import logging
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import monitor as MON
from ..operators import registry as REG
from ..operators.sessions import DEFAULT_GAP, gap_micros, stream_session_features
from ..plans.training import load_champion, purchase_probability
from ..schema import FEATURE_COLS
from . import store as STORE

log = logging.getLogger(__name__)

# Scoring trigger and registry poll interval of the reference.
SCORING_TRIGGER = "30 seconds"
POLL_SECONDS = 30


class FeatureMismatch(RuntimeError):
    """The champion was fitted on other features than the stream builds."""


@dataclass
class ChampionCache:
    """The champion of the registry; ``contract`` = (gap, distinct mode) of the sessions to be scored."""

    registry_path: str
    poll_seconds: float = POLL_SECONDS
    contract: tuple[str, str] | None = None
    model: PipelineModel | None = None
    version: str | None = None
    path: str | None = None
    last_checked: float = field(default=-1e18)

    def refresh(self, spark: SparkSession, force: bool = False) -> None:
        now = time.time()
        if not force and now - self.last_checked < self.poll_seconds:
            return
        self.last_checked = now
        row = REG.active_champion(REG.read_registry(spark, self.registry_path)).first()
        if row is None or row["hdfs_path"] == self.path:
            return
        self._check(row)
        model = load_champion(row["hdfs_path"])
        if model is None:  # keep serving the previous champion
            return
        self.model, self.path, self.version = model, row["hdfs_path"], row["version"]


    def _check(self, row) -> None:
        """A model registered with its features must meet the same ones here; older rows carry none."""
        if self.contract is None or row["gap"] is None:
            return
        gap, distinct = self.contract
        if (gap_micros(row["gap"]), row["distinct_mode"], row["features"]) != (gap_micros(gap), distinct, ",".join(FEATURE_COLS)):
            raise FeatureMismatch(f"champion {row['version']} was fitted on gap={row['gap']}, distinct={row['distinct_mode']}, "
                                  f"features={row['features']}; this stream builds gap={gap}, distinct={distinct}")


def _write_partitioned(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "batch_id")
        .parquet(path)
    )


def _score(sessions: DataFrame, model: PipelineModel, version: str, scored_at: Column, *, run_id=None, batch_id=None) -> DataFrame:
    """Prediction rows; ``run_id``/``batch_id`` are literals or, if None, the input's own columns."""
    return purchase_probability(model.transform(sessions)).select(
        "user_session",
        F.col("session_end").alias("event_time"),
        "purchase_probability",
        F.col("prediction").cast("boolean").alias("predicted_label"),
        F.lit(version).alias("model_version"),
        scored_at.alias("scored_at"),
        (F.col("run_id") if run_id is None else F.lit(run_id)).alias("run_id"),
        (F.col("batch_id") if batch_id is None else F.lit(batch_id)).cast("long").alias("batch_id"),
    )


def _write_scored(scored: DataFrame, predictions_path: str, metrics_path: str, released: bool = False) -> int:
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        STORE.write_predictions(scored, predictions_path)
        counts = MON.batch_metrics(scored, ["run_id", "batch_id"])
        if released:  # counted under a run of their own: the run's later batches may be rolled up already
            counts = counts.withColumn("run_id", F.concat("run_id", F.lit("-released")))
        _write_partitioned(counts, metrics_path)
        return counts.agg(F.sum("total")).first()[0] or 0
    finally:
        scored.unpersist()


def score_batch(batch: DataFrame, batch_id: int, *, champion: ChampionCache, predictions_path: str,
                metrics_path: str, run_id: str, pending_path: str | None = None) -> int:
    """Score one micro-batch of closed sessions; returns rows written."""
    spark = batch.sparkSession
    champion.refresh(spark)
    model, version = champion.model, champion.version
    if model is None:
        if pending_path is not None:  # 'hold': keep the sessions for a later model
            _write_partitioned(batch.withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id)),
                               pending_path)
        log.info("batch %s: no champion yet, %s", batch_id, "held" if pending_path else "skipped")
        return 0
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_in = batch.count()  # one pass over the persisted batch
        if n_in == 0:
            return 0
        at = F.lit(STORE.batch_time(spark, predictions_path, run_id, batch_id)).cast("timestamp")
        written = _write_scored(_score(batch, model, version, at, run_id=run_id, batch_id=batch_id),
                                predictions_path, metrics_path)
        if written < n_in:  # the assembler skips sessions with null/NaN features: they go to a side table
            log.warning("batch %s: %d of %d sessions had invalid features and were not scored",
                        batch_id, n_in - written, n_in)
            _write_partitioned(invalid_sessions(batch).withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id)),
                               unscored_path(predictions_path))
        return written
    finally:
        batch.unpersist()


def invalid_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with a null or NaN feature, which the assembler skips."""
    bad = F.lit(False)
    for f in FEATURE_COLS:
        bad = bad | F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
    return sessions.filter(F.coalesce(bad, F.lit(True)))


def unscored_path(predictions_path: str) -> str:
    """Where a scoring stream leaves the sessions it could not score."""
    return predictions_path.rstrip("/") + "-unscored"


def release_pending(spark: SparkSession, *, champion: ChampionCache, pending_path: str, predictions_path: str,
                    metrics_path: str) -> int:
    """Score every held session with the current champion in one pass.

    Rows keep their original ``(run_id, batch_id)``, so the predictions land in
    the partitions those batches would have written; releasing twice rewrites
    the same partitions (no duplicates).  Returns rows written.
    """
    from ..sources.lake import read_lake_if_present

    champion.refresh(spark, force=True)
    held = read_lake_if_present(spark, pending_path)
    if champion.model is None or held is None:
        return 0
    written = 0
    for run, last in held.groupBy("run_id").agg(F.max("batch_id")).collect():  # a row a run
        mine = held.filter(F.col("run_id") == run)
        at = STORE.released_at(spark, predictions_path, str(run), last)
        written += _write_scored(_score(mine, champion.model, champion.version, at), predictions_path, metrics_path, released=True)
    return written


def run_id_for(checkpoint: str) -> str:
    """A run id that stays the same across restarts from one checkpoint.

    ``batch_id`` restarts at 0 only with a new checkpoint, so (checkpoint,
    batch_id) names a micro-batch uniquely; a retried batch after a restart
    therefore overwrites its own partition instead of adding a copy.
    """
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def start_scoring(events: DataFrame, *, champion: ChampionCache, predictions_path: str, metrics_path: str,
                  checkpoint: str, run_id: str | None = None, gap: str = DEFAULT_GAP, watermark: str = DEFAULT_GAP,
                  distinct: str = "sketch", trigger: str | None = SCORING_TRIGGER, available_now: bool = False,
                  pending_path: str | None = None, discard_unscored: bool = False) -> StreamingQuery:
    """Without a champion, closed sessions are held in ``pending_path`` (by
    default beside the predictions) until :func:`release_pending`;
    ``discard_unscored`` drops them instead."""
    if champion.contract is None:
        champion.contract = (gap, distinct)
    if pending_path is None and not discard_unscored:
        pending_path = predictions_path.rstrip("/") + "-pending"
    sessions = stream_session_features(events, gap, watermark, distinct=distinct)
    run_id = run_id or run_id_for(checkpoint)

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        score_batch(batch_df, batch_id, champion=champion, predictions_path=predictions_path,
                    metrics_path=metrics_path, run_id=run_id, pending_path=pending_path)

    writer = (
        sessions.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def rollup_path(metrics_path: str) -> str:
    return metrics_path.rstrip("/") + "-rollup"


def running_counters(spark: SparkSession, metrics_path: str) -> DataFrame:
    """(metric_key, metric_value) over every scored batch, rolled up or not."""
    return STORE.polled_counters(spark, metrics_path, rollup_path(metrics_path))
