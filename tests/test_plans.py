"""Plan-shape guards: the properties the design relies on at scale."""

import re

import pytest

import __spark_entry__ as E
from clickpath.operators.sessions import session_features
from clickpath.sources.testdata import adapted_events

from conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct")
ML_KEYS = {"train_lr", "train_rf", "train_gbt", "score_sessions", "stream_scoring", "lr_optimum", "installed_threshold", "retrain_cycle"}
CORE_KEYS = sorted(k for k in E.queries() if k not in ML_KEYS and not re.match(r"op\d+_|pipeline$", k))


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["exact", "sketch"])
def test_session_features_two_exchanges(spark, mode):
    plan = physical(session_features(adapted_events(spark, SF_SMALL), distinct=mode))
    assert plan.count("Exchange ") == 2, plan
    assert "hashpartitioning(user_session" in plan and "Join" not in plan


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["session_windows"](spark, SF_SMALL)
    explained = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in explained


@pytest.mark.parametrize("key", CORE_KEYS)
def test_no_python_udfs_or_cross_joins(spark, key):
    plan = physical(E.queries()[key](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in plan]


def test_queries_without_distinct_counts_read_no_ids(spark):
    for key in ("session_labels", "session_counts", "session_bounds", "purchase_rate"):
        df = E.queries()[key](spark, SF_SMALL)
        plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert "props" not in plan.split("ReadSchema: ")[1].split("\n")[0]
        assert "collect_set" not in plan and "Generate" not in plan


@pytest.mark.parametrize("key", ["promotion_decision", "registry_state", "active_champion", "classification_metrics", "auc_ranksum",
                                 "class_weights", "time_split", "headline_stats", "recent_predictions"])
def test_sessions_are_built_once(spark, key):
    """At most one write reads ``events`` while the query is built; the query itself reads staged tables, or events once."""
    plan = physical(E.queries()[key](spark, SF_SMALL))
    assert len(re.findall(r"FileScan parquet \[[^\]]*\][^\n]*events\.parquet", plan)) <= 1


def test_checked_csv_scan_does_not_unprune_later_scans(spark, scratch):
    from clickpath.sources.events import read_event_csv_checked
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    read_event_csv_checked(spark, scratch)
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before
