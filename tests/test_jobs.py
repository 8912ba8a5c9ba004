import os

from clickpath import jobs
from clickpath.sources.testdata import raw_csv_path

from conftest import SF_MED


def test_train_job_then_monitor(spark, scratch):
    csv = raw_csv_path(spark, SF_MED)
    common = ["--models", os.path.join(scratch, "models"), "--registry", os.path.join(scratch, "reg")]
    out = jobs.main(["train", "--raw-csv", csv, "--lake", os.path.join(scratch, "lake"), "--stream",
                     os.path.join(scratch, "no-archive-yet"), "--gap", "12 hours", "--distinct", "exact", "--rejects", os.path.join(scratch, "rejects"), *common])
    assert out["promoted"] and out["champion_auc"] is None
    assert out["sessions"] > out["purchased"] > 0 and len(out["sweep"]) == 19
    assert spark.read.parquet(os.path.join(scratch, "rejects")).count() == 0
    assert os.path.exists(os.path.join(scratch, "lake", "_SUCCESS"))
    # a scored batch so the monitor has data
    from pyspark.ml import PipelineModel
    from clickpath.operators.sessions import session_features
    from clickpath.sources.events import read_event_csv
    from clickpath.streaming.scoring import ChampionCache, score_batch
    champ = ChampionCache(os.path.join(scratch, "reg"), poll_seconds=0)
    sessions = session_features(read_event_csv(spark, csv), "12 hours", with_label=False)
    n = score_batch(sessions, 0, champion=champ, predictions_path=os.path.join(scratch, "pred"),
                    metrics_path=os.path.join(scratch, "met"), run_id="r")
    assert n == sessions.count() and isinstance(champ.model, PipelineModel)
    rep = jobs.main(["monitor", "--predictions", os.path.join(scratch, "pred"), "--metrics",
                     os.path.join(scratch, "met"), "--registry", os.path.join(scratch, "reg")])
    assert rep["headline"]["total_predictions"] == n
    assert rep["champion"]["version"] == out["version"] and rep["models_trained"] == 1


def test_consume_job_catches_up_and_exits(spark, scratch):
    from clickpath.sources.testdata import raw_csv_path
    from clickpath.operators import registry as REG
    from clickpath.operators.sessions import session_features
    from clickpath.plans import training as TR
    from clickpath.sources.events import read_event_csv
    from clickpath.schema import FEATURE_COLS
    from conftest import SF_SMALL

    csv = raw_csv_path(spark, SF_SMALL)
    model, _, _ = TR.fit_and_tune(session_features(read_event_csv(spark, csv), "30 minutes"))
    model.write().overwrite().save(os.path.join(scratch, "m1"))
    reg = os.path.join(scratch, "reg")
    REG.append_registry(spark, reg, hdfs_path=os.path.join(scratch, "m1"), version="m1", trained_on="x",
                        metrics={}, promoted=True, gap="30 minutes", distinct="exact", features=FEATURE_COLS)
    paths = {k: os.path.join(scratch, k) for k in ("archive", "pred", "met", "ck")}
    jobs.main(["consume", "--source", csv, "--source-format", "csv", "--archive", paths["archive"],
               "--predictions", paths["pred"], "--metrics", paths["met"], "--checkpoints", paths["ck"],
               "--registry", reg, "--poll-seconds", "0", "--distinct", "exact", "--available-now"])
    assert spark.read.parquet(paths["archive"]).count() == read_event_csv(spark, csv).count()
    n = spark.read.parquet(paths["pred"]).count()
    assert n > 0
    rep = jobs.main(["monitor", "--predictions", paths["pred"], "--metrics", paths["met"], "--registry", reg])
    assert rep["headline"]["total_predictions"] == n and rep["champion"]["version"] == "m1"


def test_ingest_round_trip_and_counted_rejects(spark, scratch):
    from clickpath.sources.events import clean_events, decode_events, read_event_csv_checked, split_rejects
    from clickpath.sources.testdata import csv_lines
    from conftest import SF_SMALL

    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    raw = os.path.join(scratch, "raw")
    lines = csv_lines(spark, SF_SMALL).coalesce(1)
    spark.createDataFrame([(header,)], "value string").unionByName(lines).coalesce(1).write.text(raw)
    out = jobs.main(["ingest", "--raw-csv", raw, "--rejects", os.path.join(scratch, "rej"), "--out", os.path.join(scratch, "msg")])
    accepted, rejected = split_rejects(read_event_csv_checked(spark, raw))
    assert out["rejected"] == len(rejected.collect()) > 0
    messages = spark.read.schema("key string, value string").json(os.path.join(scratch, "msg"))
    back = decode_events(messages)
    assert messages.filter("key is distinct from get_json_object(value, '$.user_session')").count() == 0
    again = jobs.main(["ingest", "--raw-csv", raw, "--rejects", os.path.join(scratch, "rej"), "--out", os.path.join(scratch, "msg3")])
    assert again == out  # this run's rejects, not those of all runs
    assert sorted(map(repr, clean_events(back).collect())) == sorted(map(repr, clean_events(accepted).collect()))
    jobs.main(["ingest", "--raw-csv", raw, "--rejects", os.path.join(scratch, "rej2"), "--out", os.path.join(scratch, "msg2"),
               "--max-events", "10"])
    assert spark.read.text(os.path.join(scratch, "msg2")).count() == 10


def test_scoring_refuses_a_champion_of_other_features(spark, scratch):
    import pytest

    from clickpath.operators import registry as REG
    from clickpath.schema import FEATURE_COLS
    from clickpath.streaming.scoring import ChampionCache, FeatureMismatch

    reg = os.path.join(scratch, "reg")
    REG.append_registry(spark, reg, hdfs_path="nowhere", version="m1", trained_on="x", metrics={}, promoted=True, gap="12 hours",
                        distinct="exact", features=FEATURE_COLS)
    with pytest.raises(FeatureMismatch):
        ChampionCache(reg, poll_seconds=0, contract=("30 minutes", "exact")).refresh(spark)
    with pytest.raises(FeatureMismatch):
        ChampionCache(reg, poll_seconds=0, contract=("12 hours", "sketch")).refresh(spark)
    same = ChampionCache(reg, poll_seconds=0, contract=("720 minutes", "exact"))
    same.refresh(spark)  # the contract holds; the missing files leave it without a model
    assert same.model is None
