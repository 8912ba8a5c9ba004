import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickpath.operators.sessions import gap_micros, session_features, session_windows, sessionize
from clickpath.sources.testdata import adapted_events

from conftest import SF_SMALL
from helpers import at, ev, events_df

MIN = 60


def feats(spark, rows, gap="30 minutes", distinct="exact"):
    df = session_features(events_df(spark, rows), gap, distinct=distinct)
    return sorted(
        (r.asDict() for r in df.withColumn("ws", F.col("session.start")).drop("session").collect()),
        key=lambda r: (r["user_session"], r["ws"]),
    )


def test_gap_parsing():
    assert gap_micros("30 minutes") == 1_800_000_000
    assert gap_micros("12 hours") == 43_200_000_000
    assert gap_micros(90) == 90_000_000
    with pytest.raises(ValueError):
        gap_micros("soon")


def test_gap_exactly_equal_merges_and_one_second_more_splits(spark):
    merged = feats(spark, [ev(0), ev(30 * MIN)])
    assert len(merged) == 1 and merged[0]["view_count"] == 2
    split = feats(spark, [ev(0), ev(30 * MIN + 1)])
    assert len(split) == 2


def test_purchases_extend_window_but_not_features(spark):
    # view at 0, purchase at 25 min, view at 50 min: the purchase bridges the gap
    rows = [ev(0, price=2.0), ev(25 * MIN, "purchase", product=9, price=100.0), ev(50 * MIN, price=4.0)]
    (r,) = feats(spark, rows)
    assert r["label"] == 1
    assert r["view_count"] == 2
    assert r["max_price"] == 4.0 and r["avg_price"] == 3.0
    assert r["distinct_products"] == 1
    assert r["session_duration_sec"] == 50 * 60


def test_purchase_only_window_dropped(spark):
    rows = [ev(0, "purchase"), ev(5 * MIN, "purchase"), ev(10 * 3600)]
    out = feats(spark, rows)
    assert len(out) == 1 and out[0]["label"] == 0
    raw = sessionize(events_df(spark, rows)).collect()
    assert len(raw) == 2 and sum(r.session_start is None for r in raw) == 1


def test_unknown_and_null_types(spark):
    rows = [ev(0, "signup", product=5, price=7.0), ev(60, None, product=6, price=99.0), ev(120, "cart")]
    (r,) = feats(spark, rows)
    assert (r["view_count"], r["cart_count"], r["remove_count"]) == (0, 1, 0)
    assert r["distinct_products"] == 2  # signup counts, null type does not
    assert r["max_price"] == 7.0
    assert r["has_cart"] == 1


def test_null_fills_and_duration_floor(spark):
    rows = [ev(0.9, brand=None, price=None), ev(10.2, brand=None, price=None)]
    (r,) = feats(spark, rows)
    assert r["distinct_brands"] == 0 and r["avg_price"] == 0.0 and r["max_price"] == 0.0
    assert r["session_duration_sec"] == 10  # 10 - 0, each side floored separately


def test_window_struct_is_first_event_to_last_plus_gap(spark):
    w = session_windows(events_df(spark, [ev(0), ev(10 * MIN), ev(3 * 3600)])).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.n_events) for r in w] == [
        (at(0), at(40 * MIN), 2), (at(3 * 3600), at(3 * 3600 + 30 * MIN), 1)]


def test_modes_agree_on_small_sessions(spark):
    rows = [ev(i * 7 * MIN, random.Random(i).choice(["view", "cart", "purchase"]), product=i % 4,
               session=f"s{i % 3}") for i in range(60)]
    exact = feats(spark, rows, distinct="exact")
    for mode in ("sketch", "hllpp"):
        assert feats(spark, rows, distinct=mode) == exact


def brute_force(pdf: pd.DataFrame, gap_s: float) -> dict:
    """Pure-pandas sessionization for cross-checking (small inputs only)."""
    out = {}
    for key, g in pdf.sort_values("event_time", kind="stable").groupby("user_session"):
        sid, last = -1, None
        ids = []
        for t in g.event_time:
            if last is None or (t - last).total_seconds() > gap_s:
                sid += 1
            ids.append(sid)
            last = t
        g = g.assign(sid=ids)
        for s, h in g.groupby("sid"):
            np_ = h[h.event_type != "purchase"]
            if np_.empty:
                continue
            out[(key, h.event_time.min())] = (
                int((h.event_type == "purchase").any()), int((h.event_type == "view").sum()),
                int((h.event_type == "cart").sum()), int(np_.product_id.nunique()), int(np_.brand.nunique()),
                round(float(np_.price.mean()), 6),
            )
    return out


@pytest.mark.parametrize("gap,gap_s", [("30 minutes", 1800), ("12 hours", 43200)])
def test_matches_brute_force_on_driver_table(spark, gap, gap_s):
    events = adapted_events(spark, SF_SMALL)
    got = {
        (r.user_session, r.ws): (r.label, r.view_count, r.cart_count, r.distinct_products, r.distinct_brands,
                                 round(r.avg_price, 6))
        for r in session_features(events, gap).withColumn("ws", F.col("session.start")).collect()
    }
    assert got == brute_force(events.toPandas(), gap_s)


@pytest.mark.parametrize("mode", ["exact", "sketch", "hllpp"])
def test_hot_key_spread_over_many_buckets(spark, mode):
    # one key holds most rows and spans many buckets; chains of 20-minute gaps
    # merge across bucket borders, a 2-hour pause splits
    rows = [ev(i * 20 * MIN, product=i % 5, session="hot") for i in range(200)]
    rows += [ev(200 * 20 * MIN + 2 * 3600 + i * MIN, session="hot") for i in range(10)]
    rows += [ev(i * 3600, session=f"cold{i}") for i in range(5)]
    out = feats(spark, rows, distinct=mode)
    hot = [r for r in out if r["user_session"] == "hot"]
    assert [r["view_count"] for r in hot] == [200, 10]
    assert hot[0]["distinct_products"] == 5


def test_shuffling_input_does_not_change_features(spark):
    rows = [ev(i * 11 * MIN, ["view", "cart", "remove_from_cart", "purchase"][i % 4], product=i % 6,
               session=f"s{i % 4}") for i in range(80)]
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    assert feats(spark, rows) == feats(spark, shuffled)


def test_purchase_at_existing_timestamp_changes_only_label(spark):
    rows = [ev(0), ev(10 * MIN, "cart")]
    base = feats(spark, rows)
    with_purchase = feats(spark, rows + [ev(10 * MIN, "purchase", product=77, price=500.0)])
    assert base[0]["label"] == 0 and with_purchase[0]["label"] == 1
    assert {k: v for k, v in base[0].items() if k != "label"} == \
        {k: v for k, v in with_purchase[0].items() if k != "label"}


@pytest.mark.parametrize("mode", ["exact", "sketch", "hllpp"])
def test_rows_without_time_belong_to_no_session(spark, mode):
    import datetime as dt
    rows = [ev(0), ev(60, "cart"), (None, "view", 9, 9, None, "b9", 99.0, 1, "s1")]
    out = feats(spark, rows, distinct=mode)
    assert len(out) == 1 and out[0]["view_count"] == 1 and out[0]["max_price"] == 1.0
    assert isinstance(out[0]["ws"], dt.datetime)
    w = session_windows(events_df(spark, rows)).collect()
    assert [r.n_events for r in w] == [2]


def test_exact_merge_builds_no_set_per_session(spark):
    """Sessions of one bucket, of several with values in common, with no value at all: counted without a set in one row."""
    rows = [
        ev(0, product=1, category=1, brand="a", session="one"), ev(60, "cart", product=2, category=1, brand=None, session="one"),
        *[ev(20 * MIN * i, product=i % 3, category=i % 2, brand="ab"[i % 2], session="many") for i in range(12)],
        ev(0, product=None, category=None, brand=None, price=None, session="bare"), ev(29 * MIN, "purchase", product=9, session="bare"),
        ev(0, product=None, brand=None, price=None, session="late"), ev(30 * MIN, "purchase", session="late"), ev(60 * MIN, product=5, brand="z", session="late"),
        ev(0, "purchase", session="bought"),
    ]
    got = {r["user_session"]: (r["distinct_products"], r["distinct_categories"], r["distinct_brands"], r["view_count"], r["avg_price"], r["label"]) for r in feats(spark, rows)}
    assert got == {"one": (2, 1, 1, 1, 1.0, 0), "many": (3, 2, 2, 12, 1.0, 0), "bare": (0, 0, 0, 1, 0.0, 1), "late": (1, 1, 1, 2, 1.0, 1)}
    plan = session_features(events_df(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    merges = [line for line in plan.splitlines() if "Aggregate [user_session" in line and "_sid" in line.split("]")[0]]
    assert merges and not any("collect_set" in line for line in merges), plan
