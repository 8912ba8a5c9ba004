import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

from clickpath.operators.sessions import session_features, stream_session_features
from clickpath.operators import registry as REG
from clickpath.plans import training as TR
from clickpath.sources.testdata import adapted_events
from clickpath.functions.encode import event_json
from clickpath.streaming import scoring as SC
from clickpath.streaming.archive import start_archive
from clickpath.streaming.sources import event_stream, message_stream

from conftest import SF_SMALL

N_FILES = 6


def write_message_files(spark, src_dir, sf=SF_SMALL):
    """The driver table as JSON message files, one time slice per file, in time order."""
    ev = adapted_events(spark, sf)
    rows = ev.select("event_time", event_json(ev).alias("value")).orderBy("event_time").collect()
    os.makedirs(src_dir, exist_ok=True)
    chunk = (len(rows) + N_FILES - 1) // N_FILES
    base = time.time() - 1000
    for i in range(N_FILES):
        path = os.path.join(src_dir, f"part-{i:03d}.json")
        with open(path, "w") as f:
            f.write("\n".join(r.value for r in rows[i * chunk:(i + 1) * chunk]) + "\n")
        os.utime(path, (base + i, base + i))
    return ev


def _key(r):
    return (r["user_session"], r["session_start"])


@pytest.mark.parametrize("mode", ["exact", "hllpp", "sketch"])
def test_stream_equals_closed_batch_sessions(spark, scratch, mode):
    src = os.path.join(scratch, "src")
    write_message_files(spark, src)
    stream = event_stream(message_stream(spark, src, max_files_per_trigger=1))
    feats = stream_session_features(stream, "30 minutes", "30 minutes", distinct=mode)
    q = (feats.writeStream.format("memory").queryName(f"stream_eq_{mode}").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = [r.asDict() for r in spark.table(f"stream_eq_{mode}").drop("session").collect()]
    decoded = event_stream(spark.read.text(src))  # the same messages, read as a batch
    wm = decoded.agg(F.max("event_time")).first()[0] - datetime.timedelta(minutes=30)
    batch = session_features(decoded, "30 minutes", with_label=False, distinct=mode)
    closed = [r.asDict() for r in batch.filter(F.col("session.end") <= F.lit(wm)).drop("session").collect()]
    assert len(got) > 0.9 * batch.count()
    assert sorted(got, key=_key) == sorted(closed, key=_key)


def test_archive_sink_partitions_every_event(spark, scratch):
    src = os.path.join(scratch, "src")
    ev = write_message_files(spark, src)
    lake = os.path.join(scratch, "lake")
    q = start_archive(event_stream(message_stream(spark, src, max_files_per_trigger=2)), lake,
                      os.path.join(scratch, "ck_archive"), available_now=True)
    q.awaitTermination(300)
    back = spark.read.parquet(lake)
    assert back.count() == ev.count()
    assert {"event_type", "event_date"} <= set(back.columns)
    per_day = back.groupBy("event_date").count().count()
    assert per_day == ev.select(F.to_date("event_time")).distinct().count()


@pytest.fixture()
def champion_registry(spark, scratch):
    sessions = session_features(adapted_events(spark, SF_SMALL), "12 hours")
    model, threshold, _ = TR.fit_and_tune(sessions, "logistic_regression")
    path = os.path.join(scratch, "models", "v1")
    model.write().overwrite().save(path)
    reg = os.path.join(scratch, "registry")
    REG.append_registry(spark, reg, hdfs_path=path, version="v1", trained_on="t", metrics={"auc": 0.6},
                        promoted=True)
    return reg, model


def test_scoring_writes_once_per_batch_and_replays_idempotently(spark, scratch, champion_registry):
    reg, _ = champion_registry
    src = os.path.join(scratch, "src")
    write_message_files(spark, src)
    preds, mets = os.path.join(scratch, "pred"), os.path.join(scratch, "metrics")
    champ = SC.ChampionCache(reg, poll_seconds=0)
    q = SC.start_scoring(event_stream(message_stream(spark, src, max_files_per_trigger=2)), champion=champ,
                         predictions_path=preds, metrics_path=mets, checkpoint=os.path.join(scratch, "ck"),
                         run_id="r1", distinct="exact", available_now=True)
    q.awaitTermination(300)
    p = spark.read.parquet(preds)
    n = p.count()
    assert n > 0 and p.select("model_version").distinct().first()[0] == "v1"
    counters = {r.metric_key: r.metric_value for r in SC.running_counters(spark, mets).collect()}
    assert counters["total_predictions"] == n
    assert counters["purchase_predicted"] == p.filter("predicted_label").count()
    # a retried batch (same run and batch id, same content) replaces its own rows
    sessions = session_features(adapted_events(spark, SF_SMALL), with_label=False)
    k = sessions.count()
    for _ in range(2):
        SC.score_batch(sessions, 10_000, champion=champ, predictions_path=preds, metrics_path=mets, run_id="r1")
        assert spark.read.parquet(preds).count() == n + k
        again = {r.metric_key: r.metric_value for r in SC.running_counters(spark, mets).collect()}
        assert again["total_predictions"] == n + k


def test_champion_hot_swap_and_no_champion(spark, scratch, champion_registry):
    reg, model = champion_registry
    empty = SC.ChampionCache(os.path.join(scratch, "no_registry"), poll_seconds=0)
    batch = session_features(adapted_events(spark, SF_SMALL), with_label=False)
    assert SC.score_batch(batch, 0, champion=empty, predictions_path=os.path.join(scratch, "p0"),
                          metrics_path=os.path.join(scratch, "m0"), run_id="r") == 0
    assert not os.path.exists(os.path.join(scratch, "p0"))  # 'skip': nothing written
    held = os.path.join(scratch, "held")
    SC.score_batch(batch, 0, champion=empty, predictions_path=os.path.join(scratch, "p0"),
                   metrics_path=os.path.join(scratch, "m0"), run_id="r", pending_path=held)
    assert spark.read.parquet(held).count() == batch.count()  # 'hold': sessions kept for a later model
    champ = SC.ChampionCache(reg, poll_seconds=0)
    champ.refresh(spark)
    assert champ.version == "v1"
    path2 = os.path.join(scratch, "models", "v2")
    model.write().overwrite().save(path2)
    REG.append_registry(spark, reg, hdfs_path=path2, version="v2", trained_on="t", metrics={"auc": 0.7},
                        promoted=True)
    champ.refresh(spark)
    assert champ.version == "v2"
    REG.append_registry(spark, reg, hdfs_path=os.path.join(scratch, "missing"), version="v3", trained_on="t",
                        metrics={"auc": 0.9}, promoted=True)
    champ.refresh(spark)
    assert champ.version == "v2"  # unreadable model: keep serving the previous one


def test_archive_and_scoring_run_side_by_side(spark, scratch, champion_registry):
    """Two queries over one source, each with its own checkpoint, advance independently."""
    reg, _ = champion_registry
    src = os.path.join(scratch, "src")
    ev = write_message_files(spark, src)
    lake = os.path.join(scratch, "lake")
    archive = start_archive(event_stream(message_stream(spark, src, max_files_per_trigger=3)), lake,
                            os.path.join(scratch, "ck", "archive"), available_now=True)
    scoring = SC.start_scoring(event_stream(message_stream(spark, src, max_files_per_trigger=1)),
                               champion=SC.ChampionCache(reg, poll_seconds=0),
                               predictions_path=os.path.join(scratch, "pred"),
                               metrics_path=os.path.join(scratch, "met"),
                               checkpoint=os.path.join(scratch, "ck", "scoring"), run_id="r", available_now=True)
    archive.awaitTermination(300)
    scoring.awaitTermination(300)
    assert spark.read.parquet(lake).count() == ev.count()
    assert spark.read.parquet(os.path.join(scratch, "pred")).count() > 0
    assert archive.lastProgress["batchId"] != scoring.lastProgress["batchId"]


def test_scoring_restart_keeps_one_copy_per_session(spark, scratch, champion_registry):
    """Stop after some files, restart on the same checkpoint: each session scored once."""
    reg, _ = champion_registry
    full = os.path.join(scratch, "full")
    write_message_files(spark, full)
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    preds, mets, ck = (os.path.join(scratch, x) for x in ("pred", "met", "ck"))

    def run():
        q = SC.start_scoring(event_stream(message_stream(spark, src, max_files_per_trigger=1)),
                             champion=SC.ChampionCache(reg, poll_seconds=0), predictions_path=preds,
                             metrics_path=mets, checkpoint=ck, available_now=True)
        q.awaitTermination(300)

    names = sorted(os.listdir(full))
    for i, name in enumerate(names):
        os.link(os.path.join(full, name), os.path.join(src, name))
        if i in (2, len(names) - 1):
            run()
    p = spark.read.parquet(preds)
    assert p.count() == p.dropDuplicates(["user_session", "event_time"]).count() > 0
    assert p.select("run_id").distinct().count() == 1
    counters = {r.metric_key: r.metric_value for r in SC.running_counters(spark, mets).collect()}
    assert counters["total_predictions"] == p.count()


def test_csv_drop_folder_stream_matches_batch_scan(spark, scratch):
    from clickpath.sources.events import read_event_csv
    from clickpath.sources.testdata import raw_csv_path
    from clickpath.streaming.sources import csv_event_stream

    csv = raw_csv_path(spark, SF_SMALL)
    feats = stream_session_features(csv_event_stream(spark, csv), distinct="exact")
    q = (feats.writeStream.format("memory").queryName("csv_stream").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("csv_stream").drop("session")
    batch = read_event_csv(spark, csv)
    wm = batch.agg(F.max("event_time")).first()[0] - datetime.timedelta(minutes=30)
    closed = session_features(batch, with_label=False).filter(F.col("session.end") <= F.lit(wm)).drop("session")
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed.select(*got.columns)).count() == 0


def test_held_sessions_are_released_once_a_champion_exists(spark, scratch, champion_registry):
    reg, _ = champion_registry
    batch = session_features(adapted_events(spark, SF_SMALL), with_label=False)
    held, preds, mets = (os.path.join(scratch, x) for x in ("held", "pred", "met"))
    nobody = SC.ChampionCache(os.path.join(scratch, "empty_registry"), poll_seconds=0)
    for b in (3, 4):
        SC.score_batch(batch, b, champion=nobody, predictions_path=preds, metrics_path=mets, run_id="r",
                       pending_path=held)
    champ = SC.ChampionCache(reg, poll_seconds=0)
    n = batch.count()
    for _ in range(2):  # releasing twice rewrites the same partitions
        assert SC.release_pending(spark, champion=champ, pending_path=held, predictions_path=preds,
                                  metrics_path=mets) == 2 * n
        p = spark.read.parquet(preds)
        assert p.count() == 2 * n and sorted(r.batch_id for r in p.select("batch_id").distinct().collect()) == [3, 4]
    counters = {r.metric_key: r.metric_value for r in SC.running_counters(spark, mets).collect()}
    assert counters["total_predictions"] == 2 * n
