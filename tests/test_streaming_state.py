"""Event-time rules of the scoring stream: late data and restart from checkpoint."""

import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from clickpath.config import checkpoint_dir
from clickpath.operators.sessions import session_features, stream_session_features
from clickpath.plans.queries import QUERIES
from clickpath.sources import testdata as T
from clickpath.streaming.sources import event_stream, message_stream
from clickpath.streaming.state import PROVIDER_KEY, ROCKSDB, state_on_disk

from test_streaming import write_message_files

T0 = dt.datetime(2024, 1, 1)


def msg(minutes, session, etype="view"):
    t = (T0 + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%d %H:%M:%S UTC")
    return json.dumps({"event_time": t, "event_type": etype, "product_id": 1, "category_id": 1,
                       "category_code": None, "brand": None, "price": 1.0, "user_id": 1, "user_session": session})


def drop_file(src, i, lines):
    path = os.path.join(src, f"f{i:03d}.json")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (time.time() - 100 + i, time.time() - 100 + i))


def test_late_rows_behind_previous_watermark_are_dropped(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    feats = stream_session_features(event_stream(message_stream(spark, src, max_files_per_trigger=1)),
                                    distinct="exact")
    q = (feats.writeStream.format("memory").queryName("late_out").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(processingTime="0 seconds").start())
    try:
        drop_file(src, 0, [msg(0, "a"), msg(120, "b")])           # watermark → 90 min
        q.processAllAvailable()
        drop_file(src, 1, [msg(10, "a"), msg(100, "c")])          # a@10: 10+30 ≤ 90 → dropped; c@100 kept
        q.processAllAvailable()
        drop_file(src, 2, [msg(400, "z")])                        # advances the watermark past every session
        q.processAllAvailable()
        drop_file(src, 3, [msg(401, "z")])
        q.processAllAvailable()
        dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                      for p in q.recentProgress for op in p.get("stateOperators", []))
    finally:
        q.stop()
    out = {r.user_session: r.view_count for r in spark.table("late_out").collect()}
    assert out == {"a": 1, "b": 1, "c": 1}
    assert dropped >= 1


def test_restart_from_checkpoint_gives_no_duplicates(spark, scratch):
    full = os.path.join(scratch, "full")
    write_message_files(spark, full)
    files = sorted(os.listdir(full))
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    out = os.path.join(scratch, "out")
    ck = os.path.join(scratch, "ck")

    def run():
        feats = stream_session_features(event_stream(message_stream(spark, src, max_files_per_trigger=1)),
                                        distinct="exact")
        q = (feats.drop("session").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(300)

    for i, name in enumerate(files):
        os.link(os.path.join(full, name), os.path.join(src, name))
        if i in (2, len(files) - 1):  # stop after the third file, restart for the rest
            run()
    got = spark.read.parquet(out)
    assert got.count() == got.dropDuplicates(["user_session", "session_start"]).count()
    decoded = event_stream(spark.read.text(full))
    wm = decoded.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=30)
    closed = session_features(decoded, with_label=False, distinct="exact").filter(F.col("session.end") <= F.lit(wm))
    assert got.count() == closed.count()
    assert got.exceptAll(closed.drop("session").select(*got.columns)).count() == 0


@pytest.fixture()
def no_provider(spark):
    """A session without a chosen provider: ``jobs consume`` of other tests leaves its choice in the shared one."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.unset(PROVIDER_KEY)
    yield
    if before is not None:
        spark.conf.set(PROVIDER_KEY, before)


def test_state_on_disk_is_for_the_streams_started_inside(spark, no_provider):
    counted = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    with state_on_disk(spark):
        assert spark.conf.get(PROVIDER_KEY) == ROCKSDB and spark.conf.get(counted) == "false"
    assert spark.conf.get(PROVIDER_KEY, None) is None and spark.conf.get(counted, None) is None
    spark.conf.set(PROVIDER_KEY, "chosen by the cluster")
    try:
        with state_on_disk(spark):
            assert spark.conf.get(PROVIDER_KEY) == "chosen by the cluster" and spark.conf.get(counted, None) is None
        assert spark.conf.get(PROVIDER_KEY) == "chosen by the cluster"
    finally:
        spark.conf.unset(PROVIDER_KEY)


def test_stream_scoring_scores_every_closed_session_from_state_on_disk(spark, scratch, no_provider):
    sf = os.path.join(scratch, "sf")
    types = ("view", "click", "purchase", "error", "signup")
    rows = [(i, T0 + dt.timedelta(minutes=17 * i), i % 7, types[(i * i + i // 7) % 5], 1.0 + i % 9, json.dumps({"k": i % 23})) for i in range(600)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{sf}/events.parquet")
    got = QUERIES["stream_scoring"](spark, sf)
    wm = rows[-1][1] - dt.timedelta(minutes=30)
    closed = session_features(T.adapted_events(spark, sf)).filter(F.col("session.end") <= F.lit(wm))
    want = closed.select("user_session", F.col("session_end").cast("timestamp_ntz").alias("event_time"), F.lit("v1"), F.lit(True))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 100
    offsets = glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/clickpath-work/{T._fingerprint(sf)}/streams/scoring-*/checkpoint/offsets/0")
    assert len(offsets) == 1 and json.loads(open(offsets[0]).read().splitlines()[1])["conf"][PROVIDER_KEY] == ROCKSDB
    assert spark.conf.get(PROVIDER_KEY, None) is None
