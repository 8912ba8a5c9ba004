"""Registered queries: one builder per operator key, ``(spark, sf_dir) → DataFrame``.

Every builder reads the driver tables (only ``events`` is used) or tables that
Spark derives from them, over the whole table.  Output conventions shared
with the DuckDB oracles in :mod:`clickpath.plans.oracle`: timestamps are
emitted as ``timestamp_ntz`` and doubles are rounded to 6 places.

Derived inputs (see ``FIXTURES.md`` §4 in the repository):

* ``rule_scored`` — 12-hour sessions with a fixed integer score
  ``score_pct = (7·views + 31·carts + 13·distinct products + duration) % 100``
  and probability ``score_pct / 100``.  It stands in for a fitted model so
  that all metric arithmetic can be checked exactly; the ``train_*`` keys
  run the real MLlib models.
* ``predictions`` — those sessions as the scoring sink writes them
  (``scored_at`` = session end; model ``v1`` for sessions in the training
  time range, ``v2`` after it); ``as_of`` is the newest ``scored_at``.
* ``registry`` — one challenger per day: a second fixed score (``v2``) is
  compared with the standing champion score (``v1``) on that day's sessions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampType

from ..config import prepare, work_path
from ..functions.sanitize import blank_to_null, sanitize_double, sanitize_long
from ..operators import metrics as M
from ..operators import monitor as MON
from ..operators import registry as REG
from ..operators import sessions as S
from ..schema import CORE_COLUMNS
from ..sources import events as E
from ..sources import lake as L
from ..sources import testdata as T
from ..sources.stage import stage

# Session gaps of the checks, intake cap (a share of the rows), replay cut points.
GAP = "30 minutes"
LONG_GAP = "12 hours"
INTAKE_SHARE = 0.5
STREAM_SPLIT = 0.5
REPLAY_FROM = 0.75
SCORE_PCT_THRESHOLD = 50
# Loss slope, per standard deviation of a feature, below which a fit counts as an optimum.
MAX_SLOPE = 0.01


# --------------------------------------------------------------------------
# output conventions
# --------------------------------------------------------------------------

def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _window_cols(df: DataFrame) -> list[Column]:
    return [F.col("user_session"), F.col("session.start").alias("window_start"),
            F.col("session.end").alias("window_end")]


# --------------------------------------------------------------------------
# shared derived inputs
# --------------------------------------------------------------------------

def events(spark: SparkSession, sf: str) -> DataFrame:
    return T.adapted_events(prepare(spark), sf)


def sessions(spark: SparkSession, sf: str, gap: str = GAP, distinct: str = "exact") -> DataFrame:
    return S.session_features(events(spark, sf), gap, distinct=distinct)


def raw_sessions(spark: SparkSession, sf: str, gap: str = GAP, distinct: str = "none") -> DataFrame:
    return S.sessionize(events(spark, sf), gap, distinct=distinct)


def _score_pct() -> Column:
    return (F.col("view_count") * 7 + F.col("cart_count") * 31 + F.col("distinct_products") * 13
            + F.col("session_duration_sec")) % 100


def _score_pct_v2() -> Column:
    return (F.col("cart_count") * 29 + F.col("remove_count") * 17 + F.col("distinct_categories") * 11
            + F.floor(F.col("session_duration_sec") / 60)) % 100


def rule_scored(spark: SparkSession, sf: str) -> DataFrame:
    return (
        sessions(spark, sf, LONG_GAP)
        .withColumn("score_pct", _score_pct().cast("long"))
        .withColumn("score_pct_v2", _score_pct_v2().cast("long"))
        .withColumn("purchase_probability", F.col("score_pct").cast("double") / 100.0)
        .withColumn("probability_v2", F.col("score_pct_v2").cast("double") / 100.0)
    )


def _split(spark: SparkSession, sf: str) -> DataFrame:
    # Built once: the cutoffs and whatever the query does read the staged table.
    scored = stage(rule_scored(spark, sf), "scored")
    return M.split_label(scored, M.split_cutoffs(scored))


def _predictions_from(labelled: DataFrame) -> DataFrame:
    version = F.when(F.col("split") == "train", F.lit("v1")).otherwise(F.lit("v2"))
    return labelled.select(
        "user_session",
        F.col("session_end").alias("event_time"),
        "purchase_probability",
        (F.col("score_pct") >= SCORE_PCT_THRESHOLD).alias("predicted_label"),
        version.alias("model_version"),
        F.col("session_end").alias("scored_at"),
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions_from(_split(spark, sf))


def baseline_and_streamed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Baseline = up to the middle of the time range; streamed = after it, with
    the tail from 75% of the range replayed a second time (offset reset).
    The cut points come from one aggregate row of the time bounds."""
    ev = events(spark, sf)
    lo, hi = ev.agg(F.min(F.col("event_time").cast("long")), F.max(F.col("event_time").cast("long"))).first()
    if lo is None:
        return ev, ev.limit(0)
    mid, tail = lo + int((hi - lo) * STREAM_SPLIT), lo + int((hi - lo) * REPLAY_FROM)
    t = F.col("event_time").cast("long")
    streamed = ev.filter(t > mid).unionByName(ev.filter(t > tail))
    return ev.filter(t <= mid), streamed


def registry_log(spark: SparkSession, sf: str) -> DataFrame:
    # one row per day; the readers below look at it more than once
    decisions = stage(promotion_decision(spark, sf, rounded=False), "decisions")
    return decisions.select(
        F.concat(F.date_format("day", "yyyyMMdd"), F.lit("_000000")).alias("version"),
        F.date_format("day", "yyyy-MM-dd").alias("trained_on"),
        F.col("auc_challenger").alias("auc_score"),
        "promoted",
        (F.col("day").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("created_at"),
    )


def _monitor_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions without the model version (which the counters, headline and
    trend reports do not read), so no split cutoffs are needed."""
    return rule_scored(spark, sf).select(
        "user_session",
        F.col("session_end").alias("event_time"),
        "purchase_probability",
        (F.col("score_pct") >= SCORE_PCT_THRESHOLD).alias("predicted_label"),
        F.col("session_end").alias("scored_at"),
    )


def _monitor_inputs(spark: SparkSession, sf: str):
    """Monitor predictions and ``as_of`` = the newest ``scored_at``.

    ``scored_at`` is a session end, i.e. the newest non-purchase event of a
    kept session; every non-purchase event belongs to a kept session, so the
    newest session end is simply the newest non-purchase event time: a pruned
    one-column scan instead of a second sessionization pass.
    """
    as_of = events(spark, sf).filter(F.col("event_type") != "purchase") \
        .agg(F.max(F.unix_micros("event_time"))).first()[0]
    return _monitor_predictions(spark, sf), as_of


# --------------------------------------------------------------------------
# cleaning and lake
# --------------------------------------------------------------------------

def q_events_scan(spark, sf):
    prepare(spark)
    return finish(E.read_event_csv(spark, T.raw_csv_path(spark, sf)).select(*CORE_COLUMNS))


def q_lake_scan(spark, sf):
    prepare(spark)
    src = E.read_event_csv(spark, T.raw_csv_path(spark, sf))
    path = work_path(spark, T._fingerprint(sf), "lake_by_event_type")
    with T.path_lock(path):
        lake = L.load_or_create_lake(spark, src, path, partition_by=("event_type",))
    return finish(lake)


def q_decode_events(spark, sf):
    return finish(E.decode_events(T.edge_messages(prepare(spark), sf)).select(*CORE_COLUMNS))


def q_encode_events(spark, sf):
    return T.messages(prepare(spark), sf)


def q_clean_events(spark, sf):
    return finish(E.clean_events(E.decode_events(T.edge_messages(prepare(spark), sf))))


def q_sanitize_ids(spark, sf):
    w = T.wire_text(prepare(spark), sf)
    return w.select("event_id", *[sanitize_long(F.col(c)).alias(c) for c in ("product_id", "category_id", "user_id")])


def q_sanitize_price(spark, sf):
    w = T.wire_text(prepare(spark), sf)
    return finish(w.select("event_id", sanitize_double(F.col("price")).alias("price")))


def q_sanitize_text(spark, sf):
    w = T.wire_text(prepare(spark), sf)
    return w.select("event_id", *[blank_to_null(F.col(c)).alias(c) for c in ("category_code", "brand")])


def q_reject_summary(spark, sf):
    prepare(spark)
    accepted, rejected = E.split_rejects(E.read_event_csv_checked(spark, T.csv_lines_path(spark, sf), header=False))
    # a scan may not read the corrupt-record column alone: name a data column on every side
    side = lambda df, name: df.select(F.when(F.length(F.coalesce("event_type", F.lit(""))) >= 0, name).alias("side"))
    sides = side(accepted, "accepted").unionByName(side(rejected, "rejected")).unionByName(side(E.clean_events(accepted), "clean"))
    count = lambda *names: F.count_if(F.col("side").isin(*names))
    return sides.agg(count("accepted", "rejected").alias("n_lines"), count("accepted").alias("n_accepted"),
                     count("rejected").alias("n_rejected"), count("clean").alias("n_clean"))


def q_bounded_replay(spark, sf):
    ev = E.clean_events(events(spark, sf))
    return finish(E.bounded_replay(ev, int(ev.count() * INTAKE_SHARE)))


def q_archive_layout(spark, sf):
    ev = events(spark, sf)
    return ev.groupBy("event_type", F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n_events"))


def q_dedup_events(spark, sf):
    """All events with the replayed tail a second time."""
    baseline, streamed = baseline_and_streamed(spark, sf)
    return finish(baseline.unionByName(streamed).dropDuplicates(CORE_COLUMNS))


def q_consolidate(spark, sf):
    baseline, streamed = baseline_and_streamed(spark, sf)
    return finish(L.consolidate(baseline, streamed, dedup="stream"))


# --------------------------------------------------------------------------
# sessions
# --------------------------------------------------------------------------

def q_session_windows(spark, sf):
    return finish(S.session_windows(events(spark, sf), GAP))


def _raw_select(spark, sf, cols, distinct="none"):
    r = raw_sessions(spark, sf, distinct=distinct)
    return finish(r.select(*_window_cols(r)[:2], *cols))


def q_session_bounds(spark, sf):
    return _raw_select(spark, sf, ["session_start", "session_end"])


def q_session_labels(spark, sf):
    return _raw_select(spark, sf, ["label"])


def q_session_counts(spark, sf):
    return _raw_select(spark, sf, ["view_count", "cart_count", "remove_count"])


def q_session_distincts(spark, sf):
    return _raw_select(spark, sf, ["distinct_products", "distinct_categories", "distinct_brands"], "exact")


def q_session_prices(spark, sf):
    return _raw_select(spark, sf, ["avg_price", "max_price"])


def q_purchase_only_windows(spark, sf):
    r = raw_sessions(spark, sf)
    return r.agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.count(F.when(F.col("session_start").isNull(), 1)).alias("purchase_only_windows"),
        F.count(F.when(F.col("session_start").isNotNull(), 1)).alias("kept_windows"),
    )


def _features_out(df: DataFrame) -> DataFrame:
    return finish(df.select(*_window_cols(df), *[c for c in df.columns if c not in ("user_session", "session")]))


def q_session_features(spark, sf):
    return _features_out(sessions(spark, sf, GAP))


def q_session_features_12h(spark, sf):
    return _features_out(sessions(spark, sf, LONG_GAP))


def q_approx_distincts(spark, sf):
    df = sessions(spark, sf, GAP, distinct="hllpp")
    return finish(df.select(*_window_cols(df)[:2], "distinct_products", "distinct_categories", "distinct_brands"))


# --------------------------------------------------------------------------
# learning (relational metric forms over the rule score)
# --------------------------------------------------------------------------

def q_time_split(spark, sf):
    labelled = _split(spark, sf)
    return finish(labelled.select(*_window_cols(labelled)[:2], "session_start", "split"))


def _part(spark, sf, name):
    return _split(spark, sf).filter(F.col("split") == name)


def q_class_balance(spark, sf):
    return M.class_balance(_part(spark, sf, "train"))


def q_class_weights(spark, sf):
    return finish(M.class_weight_table(_part(spark, sf, "train")))


def q_purchase_rate(spark, sf):
    s = sessions(spark, sf, GAP, distinct="none")
    agg = s.agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("label").cast("long").alias("n_purchased"))
    return finish(agg.withColumn(
        "purchase_pct", 100.0 * F.col("n_purchased") / F.greatest(F.col("n_sessions"), F.lit(1))))


def _sweep(spark, sf):
    return M.threshold_sweep(_part(spark, sf, "val"))


def q_threshold_sweep(spark, sf):
    return finish(_sweep(spark, sf))


def q_best_threshold(spark, sf):
    return finish(M.best_threshold(_sweep(spark, sf)).select("threshold", "f1", "precision", "recall"))


def q_auc_ranksum(spark, sf):
    """Over two scores: the rule score (at most 100 values) and the mean price, with almost as many values as sessions."""
    test = _part(spark, sf, "test")
    both = test.select("label", F.explode(F.array(
        F.struct(F.lit("rule").alias("score"), F.col("purchase_probability").alias("p")),
        F.struct(F.lit("price").alias("score"), F.col("avg_price").alias("p")))).alias("s")).select("label", "s.*")
    return finish(M.area_under_roc(both, score_col="p", group_cols=["score"]))


def q_classification_metrics(spark, sf):
    """Tune on validation and evaluate on test from one pass: both splits are
    swept together; the test row at the best validation threshold gives the
    confusion counts."""
    both = _split(spark, sf).filter(F.col("split").isin("val", "test"))
    sweep = M.threshold_sweep(both, group_cols=["split"])
    best = M.best_threshold(sweep.filter(F.col("split") == "val").drop("split", "pos_total", "neg_total")) \
        .select(F.col("threshold").alias("decision_threshold"))
    test = sweep.filter(F.col("split") == "test")
    # ``best`` is one row by construction (limit 1): a fixed-size broadcast.
    at = test.join(F.broadcast(best), test["threshold"] == best["decision_threshold"])
    counts = at.select(
        (F.col("pos_total") + F.col("neg_total")).alias("n"), "tp", "fp", "fn",
        (F.col("neg_total") - F.col("fp")).alias("tn"), "decision_threshold",
    )
    return finish(M.metrics_from_confusion(counts, keep=["decision_threshold"]))


def promotion_decision(spark, sf, rounded: bool = True):
    scored = rule_scored(spark, sf).withColumn("day", F.to_date("session_start"))
    # both scores in one frame, so that the sessions are built and counted once
    both = scored.select("day", "label", F.explode(F.array(
        F.struct(F.lit("champion").alias("model"), F.col("purchase_probability").alias("p")),
        F.struct(F.lit("challenger").alias("model"), F.col("probability_v2").alias("p")))).alias("s")).select("day", "label", "s.*")
    aucs = M.area_under_roc(both, score_col="p", group_cols=["day", "model"])
    of = lambda model, c: F.max(F.when(F.col("model") == model, F.col(c)))
    out = (
        aucs.groupBy("day").agg(of("challenger", "auc").alias("auc_challenger"), of("challenger", "n_pos").alias("n_pos"),
                                of("challenger", "n_neg").alias("n_neg"), of("champion", "auc").alias("auc_champion"))
        .withColumn("improvement", F.col("auc_challenger") - F.col("auc_champion"))
        .withColumn("promoted", F.col("auc_challenger").isNotNull()
                    & M.promote(F.col("auc_challenger"), F.col("auc_champion")))
    )
    return finish(out) if rounded else out


def q_promotion_decision(spark, sf):
    return promotion_decision(spark, sf)


def q_registry_state(spark, sf):
    return finish(REG.registry_state(registry_log(spark, sf)))


def q_active_champion(spark, sf):
    return finish(REG.active_champion(registry_log(spark, sf)))


def q_registry_listing(spark, sf):
    return finish(REG.registry_listing(registry_log(spark, sf)))


def q_registry_history(spark, sf):
    from pyspark.sql import Window
    log = registry_log(spark, sf)
    # One row per training cycle (per day here): the registry is metadata.
    pos = F.row_number().over(Window.orderBy("created_at", "version")).cast("long")
    return finish(REG.registry_history(log).withColumn("position", pos))


# --------------------------------------------------------------------------
# monitor
# --------------------------------------------------------------------------

def _counters(pred: DataFrame) -> DataFrame:
    batched = pred.withColumn("batch_id", F.date_trunc("hour", "scored_at"))
    return MON.running_counters(MON.batch_metrics(batched))


def q_running_counters(spark, sf):
    return _counters(_monitor_predictions(spark, sf))


def q_headline_stats(spark, sf):
    return finish(MON.headline_of(_monitor_predictions(spark, sf)))


def q_avg_probability(spark, sf):
    pred, as_of = _monitor_inputs(spark, sf)
    return finish(MON.avg_probability(pred, as_of))


def q_trend(spark, sf):
    pred, as_of = _monitor_inputs(spark, sf)
    return finish(MON.trend(pred, as_of))


def q_recent_predictions(spark, sf):
    return finish(MON.recent_predictions(predictions(spark, sf)))


# --------------------------------------------------------------------------
# streaming (stateful operators run to completion over the derived message files)
# --------------------------------------------------------------------------

def _run_dir(spark: SparkSession, sf: str, name: str) -> str:
    import uuid
    return work_path(spark, T._fingerprint(sf), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def q_stream_sessions(spark, sf):
    """Every event as a JSON message → stateful ``session_window`` with a
    30-minute watermark (append) → Parquet file sink.  One trigger takes all
    files, then the watermark (newest event − 30 min) closes every session
    ending at or before it; those rows are the result."""
    from ..streaming.sources import event_stream, message_stream

    prepare(spark)
    run = _run_dir(spark, sf, "sessions")
    feats = S.stream_session_features(event_stream(message_stream(spark, T.messages_path(spark, sf))),
                                      GAP, GAP, distinct="exact")
    flat = feats.select(*_window_cols(feats), *[c for c in feats.columns if c not in ("user_session", "session")])
    q = (flat.writeStream.format("parquet").option("path", f"{run}/out")
         .option("checkpointLocation", f"{run}/checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return finish(spark.read.parquet(f"{run}/out"))


def q_archive_stream(spark, sf):
    """Every event as a JSON message → archive sink partitioned by type and
    date → read back with partition discovery; events per partition."""
    from ..streaming.archive import start_archive
    from ..streaming.sources import event_stream, message_stream

    prepare(spark)
    run = _run_dir(spark, sf, "archive")
    q = start_archive(event_stream(message_stream(spark, T.messages_path(spark, sf))), f"{run}/lake",
                      f"{run}/checkpoint", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{run}/lake").groupBy("event_type", "event_date").agg(
        F.count(F.lit(1)).alias("n_events"))


def q_stream_scoring(spark, sf):
    """The scoring stream end to end: a logistic regression champion is fitted,
    saved and registered; the message files stream through the stateful
    session features into ``foreachBatch`` scoring with idempotent sinks; the
    keys of the predictions table are the result, and whether each probability
    is one (the scores are model values)."""
    from . import training as TR
    from ..streaming import scoring as SC
    from ..streaming.sources import event_stream, message_stream
    from ..streaming.state import state_on_disk

    prepare(spark)
    run = _run_dir(spark, sf, "scoring")
    model, _, _ = TR.fit_and_tune(stage(sessions(spark, sf, GAP), "training-sessions"), "logistic_regression")
    model.write().overwrite().save(f"{run}/models/v1")
    REG.append_registry(spark, f"{run}/registry", hdfs_path=f"{run}/models/v1", version="v1", trained_on=sf,
                        metrics={}, promoted=True, gap=GAP, distinct="exact", features=S.feature_columns())
    events_in = event_stream(message_stream(spark, T.messages_path(spark, sf)))
    with state_on_disk(spark):  # one trigger takes all files: its state is every session
        q = SC.start_scoring(events_in, champion=SC.ChampionCache(f"{run}/registry", poll_seconds=0),
                             predictions_path=f"{run}/predictions", metrics_path=f"{run}/metrics",
                             checkpoint=f"{run}/checkpoint", gap=GAP, distinct="exact", available_now=True)
    q.awaitTermination()
    return finish(_scored_keys(spark.read.parquet(f"{run}/predictions")))


def _scored_keys(predictions: DataFrame) -> DataFrame:
    return predictions.select("user_session", "event_time", "model_version",
                              F.col("purchase_probability").between(0.0, 1.0).alias("probability_valid"))


# --------------------------------------------------------------------------
# MLlib (fitted values are not SQL-expressible: what they were fitted on is)
# --------------------------------------------------------------------------

def _train(spark, sf, model_type):
    from . import training as TR
    s = stage(sessions(spark, sf, LONG_GAP), "training-sessions")
    model, threshold, parts = TR.fit_and_tune(s, model_type)
    m = TR.evaluate(model, parts[2])
    labelled = M.split_label(s, M.split_cutoffs(s))
    in_split = lambda name: F.count_if(F.col("split") == name)
    negatives, positives = (F.count_if((F.col("split") == "train") & (F.col("label") == y)) for y in (0, 1))
    rows = labelled.agg(in_split("train").alias("train_rows"), in_split("val").alias("val_rows"), in_split("test").alias("test_rows"),
                        negatives.alias("negatives"), positives.alias("positives"))
    valid = all(0.0 <= v <= 1.0 for v in m.values()) and 0.05 <= threshold <= 0.95
    return finish(rows.select(F.lit(model_type).alias("model_type"), "*",
                              (F.col("negatives") / F.nullif(F.col("positives"), F.lit(0))).alias("weight_ratio"),
                              F.lit(valid).alias("metrics_valid")))


def q_train_lr(spark, sf):
    return _train(spark, sf, "logistic_regression")


def q_train_rf(spark, sf):
    return _train(spark, sf, "random_forest")


def q_train_gbt(spark, sf):
    return _train(spark, sf, "gbt")


def q_score_sessions(spark, sf):
    from . import training as TR
    s = stage(sessions(spark, sf, LONG_GAP), "training-sessions")
    model, _, _ = TR.fit_and_tune(s, "logistic_regression")
    return finish(_scored_keys(TR.score(model, s, "lr")))


def q_lr_optimum(spark, sf):
    """Whether the fitted logistic model stands at the optimum of its weighted loss, slope by slope."""
    from . import training as TR
    model, _, (train, _, _) = TR.fit_and_tune(stage(sessions(spark, sf, LONG_GAP), "training-sessions"), "logistic_regression")
    return TR.fit_gradient(model, train).select("feature", F.coalesce(F.abs("gradient") < MAX_SLOPE, F.lit(True)).alias("at_optimum"))


def q_installed_threshold(spark, sf):
    """The tuned threshold as installed in a logistic and a tree model: all test rows stand on the right side of it."""
    from . import training as TR
    s = stage(sessions(spark, sf, LONG_GAP), "training-sessions")
    parts = []
    for model_type in ("logistic_regression", "random_forest"):
        model, threshold, (_, _, test) = TR.fit_and_tune(s, model_type)
        parts.append(TR.threshold_faults(model, threshold, test).select(F.lit(model_type).alias("model_type"), "n_scored", "n_faults"))
    return parts[0].unionByName(parts[1])


def q_retrain_cycle(spark, sf):
    """Two full cycles over all events: the first model is promoted, an equal challenger is not."""
    from . import training as TR
    prepare(spark)
    run = _run_dir(spark, sf, "retrain")
    totals = []
    for version in ("v1", "v2"):
        done = TR.run_training_cycle(spark, events(spark, sf), f"{run}/models", f"{run}/registry", gap=LONG_GAP, distinct="exact", version=version)
        totals.append((version, done["sessions"], done["purchased"]))
    log = REG.read_registry(spark, f"{run}/registry").select("version", "promoted")
    active = REG.active_champion(REG.read_registry(spark, f"{run}/registry")).select(F.col("version").alias("active_version"))
    counts = spark.createDataFrame(totals, "version string, n_sessions long, n_purchased long")
    return log.join(counts, "version").join(active, F.col("version") == F.col("active_version"), "left").select(
        "version", "promoted", F.col("active_version").isNotNull().alias("is_active"), "n_sessions", "n_purchased")


def q_lake_presence(spark, sf):
    """What the lake checks say of a missing folder, an empty one, a write without its end mark and a finished lake."""
    prepare(spark)
    run = _run_dir(spark, sf, "presence")
    ev = events(spark, sf)
    fs, empty = L._fs_path(spark, f"{run}/empty")
    fs.mkdirs(empty)
    ev.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{run}/unfinished")
    L.write_lake(ev, f"{run}/finished", partition_by=("event_type",))
    rows = []
    for name in ("missing", "empty", "unfinished", "finished"):
        path = f"{run}/{name}"
        found = L.read_lake_if_present(spark, path)
        rows.append((name, L.path_exists(spark, path), L.write_complete(spark, path), found.count() if found is not None else None))
    return spark.createDataFrame(rows, "folder string, present boolean, complete boolean, n_events long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
