"""The dashboard behaviours, as relational queries with an explicit as_of."""

import datetime as dt

import pytest

from clickpath.operators import monitor as MON
from clickpath.operators import registry as REG
from clickpath.schema import PREDICTION_SCHEMA, REGISTRY_SCHEMA

NOW = dt.datetime(2026, 1, 1, 12, 0, 30)


def preds(spark, rows):
    data = [(f"s-{m}-{lab}", NOW, 0.9 if lab else 0.1, lab, "test", NOW - dt.timedelta(minutes=m)) for m, lab in rows]
    return spark.createDataFrame(data, PREDICTION_SCHEMA)


def counters(spark, total, purchase):
    return spark.createDataFrame([("total_predictions", total), ("purchase_predicted", purchase)],
                                 "metric_key string, metric_value long")


def test_zeros_when_empty(spark):
    empty_b = spark.createDataFrame([], "batch_id long, total long, purchases long")
    assert {r.metric_key: r.metric_value for r in MON.running_counters(empty_b).collect()} == {
        "total_predictions": 0, "purchase_predicted": 0}
    (h,) = MON.headline_stats(spark.createDataFrame([], "metric_key string, metric_value long"),
                              preds(spark, [])).collect()
    assert (h.total_predictions, h.purchase_rate, h.latest_scored_at) == (0, 0.0, None)


def test_reads_counters_and_rate(spark):
    (h,) = MON.headline_stats(counters(spark, 5000, 340), preds(spark, [])).collect()
    assert (h.total_predictions, h.purchase_predicted, h.no_purchase_predicted) == (5000, 340, 4660)
    (h,) = MON.headline_stats(counters(spark, 1000, 68), preds(spark, [])).collect()
    assert h.purchase_rate_api == 6.8


def test_trend_window_and_order(spark):
    assert sum(r.total for r in MON.trend(preds(spark, [(2, False), (500, False)]), NOW).collect()) == 1
    rows = MON.trend(preds(spark, [(1, False), (5, False), (10, False)]), NOW).collect()
    assert len(rows) == 3 and [r.minute for r in rows] == sorted(r.minute for r in rows)
    (r,) = MON.trend(preds(spark, [(1, True), (1, False)]), NOW).collect()
    assert r.purchase_rate == 50.0


def test_avg_probability_window(spark):
    (r,) = MON.avg_probability(preds(spark, [(1, True), (2, False), (90, True)]), NOW).collect()
    assert r.avg_probability == pytest.approx(0.5)
    (r,) = MON.avg_probability(preds(spark, [(90, True)]), NOW).collect()
    assert r.avg_probability == 0.0


def test_recent_predictions_newest_first(spark):
    rows = MON.recent_predictions(preds(spark, [(m, False) for m in range(30)]), 20).collect()
    assert len(rows) == 20 and rows[0].user_session == "s-0-False"


def reg_rows(spark, rows):
    data = [(f"/m/{v}", v, "2019-10", auc, None, None, None, None, None, 0.5, promoted, created, "30 minutes", "exact", None)
            for v, auc, promoted, created in rows]
    return spark.createDataFrame(data, REGISTRY_SCHEMA)


def test_registry_active_champion(spark):
    t = dt.datetime(2026, 1, 1)
    assert REG.active_champion(reg_rows(spark, [])).first() is None
    log = reg_rows(spark, [("v1", 0.8, True, t), ("v2", 0.81, False, t + dt.timedelta(hours=1)),
                           ("v3", 0.85, True, t + dt.timedelta(hours=2)),
                           ("v4", 0.86, True, t + dt.timedelta(hours=3)), ("v5", 0.9, True, t + dt.timedelta(hours=3))])
    assert REG.active_champion(log).first().version == "v5"   # equal created_at: version breaks the tie
    state = {r.version: (r.is_active, r.n_models) for r in REG.registry_state(log).collect()}
    assert state["v5"] == (True, 5) and not state["v1"][0]
    assert [r.version for r in REG.registry_history(log).collect()] == ["v1", "v2", "v3", "v4", "v5"]
    listing = REG.registry_listing(log).collect()
    assert [(r.version, r.is_active) for r in listing] == [("v5", True), ("v4", False), ("v3", False), ("v2", False), ("v1", False)]


def test_registry_rows_from_before_the_feature_columns(spark, tmp_path):
    path = str(tmp_path / "old")
    reg_rows(spark, [("v1", 0.8, True, dt.datetime(2026, 1, 1))]).drop("gap", "distinct_mode", "features").write.parquet(path)
    REG.append_registry(spark, path, hdfs_path="/m/b", version="v2", trained_on="x", metrics={}, promoted=False, gap="1 hour",
                        distinct="exact", features=["a"], created_at=dt.datetime(2026, 1, 2))
    got = {r.version: (r.gap, r.features) for r in REG.read_registry(spark, path).collect()}
    assert got == {"v1": (None, None), "v2": ("1 hour", "a")}


def test_headline_from_predictions_equals_the_counter_form(spark):
    for data in ([], [(m, m % 3 == 0) for m in range(10)]):
        pred = preds(spark, data)
        counters = MON.running_counters(MON.batch_metrics(pred, "model_version"))
        assert MON.headline_of(pred).collect() == MON.headline_stats(counters, pred).collect()


def test_registry_append_log(spark, scratch):
    path = f"{scratch}/registry"
    assert REG.read_registry(spark, path).count() == 0
    REG.append_registry(spark, path, hdfs_path="/m/a", version="a", trained_on="x", metrics={"auc": 0.7},
                        promoted=True, created_at=dt.datetime(2026, 1, 1))
    REG.append_registry(spark, path, hdfs_path="/m/b", version="b", trained_on="x", metrics={"auc": 0.71},
                        promoted=False, created_at=dt.datetime(2026, 1, 2))
    log = REG.read_registry(spark, path)
    assert log.count() == 2 and REG.active_champion(log).first().version == "a"


def test_recent_predictions_equal_full_sort(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(4)
    data = [(f"s{rnd.randint(0, 30)}", NOW - dt.timedelta(seconds=rnd.randint(0, 500)), rnd.random(), True, "v",
             NOW - dt.timedelta(seconds=rnd.randint(0, 400))) for _ in range(300)]
    pred = spark.createDataFrame(data, PREDICTION_SCHEMA)
    want = pred.orderBy(F.col("scored_at").desc(), F.col("user_session").asc(), F.col("event_time").desc()) \
        .limit(20).select("user_session", "purchase_probability", "predicted_label", "model_version", "scored_at")
    for n in (1, 20, 299, 300, 400):
        got = MON.recent_predictions(pred, n)
        assert got.count() == min(n, 300)
        full = pred.orderBy(F.col("scored_at").desc(), F.col("user_session").asc(), F.col("event_time").desc()) \
            .limit(n).select(*got.columns)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in full.collect()], n
    assert MON.recent_predictions(pred).collect() == want.collect()
