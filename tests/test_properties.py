"""Property checks with generated event tables."""

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickpath.operators.sessions import session_features
from clickpath.plans import training as TR
from clickpath.operators import registry as REG
from clickpath.sources.lake import consolidate
from clickpath.sources.testdata import adapted_events

from conftest import SF_MED, SF_SMALL
from helpers import ev, events_df
from test_sessions import brute_force

TYPES = ["view", "cart", "remove_from_cart", "purchase", "signup"]

event = st.tuples(
    st.integers(0, 6 * 3600),                  # seconds since T0
    st.sampled_from(TYPES),
    st.integers(0, 5),                         # product
    st.sampled_from(["b1", "b2", None]),
    st.sampled_from(["u1", "u2", "u3"]),
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=40), st.sampled_from([("30 minutes", 1800), ("1 hour", 3600)]))
def test_sessions_equal_brute_force(spark, rows, gap):
    df = events_df(spark, [ev(t, et, product=p, brand=b, session=s, price=float(p)) for t, et, p, b, s in rows])
    got = {
        (r.user_session, r.ws): (r.label, r.view_count, r.cart_count, r.distinct_products, r.distinct_brands,
                                 round(r.avg_price, 6))
        for r in session_features(df, gap[0]).withColumn("ws", F.col("session.start")).collect()
    }
    assert got == brute_force(df.toPandas(), gap[1])


def test_duplicated_stream_rows_do_not_change_consolidate(spark):
    ev_all = adapted_events(spark, SF_SMALL)
    cut = ev_all.agg(F.expr("percentile_approx(unix_seconds(event_time), 0.5)")).first()[0]
    t = F.unix_seconds("event_time")
    base, stream = ev_all.filter(t <= cut), ev_all.filter(t > cut)
    once = consolidate(base, stream)
    thrice = consolidate(base, stream.unionByName(stream).unionByName(stream))
    assert once.count() == ev_all.count()
    assert thrice.exceptAll(once).count() == 0 and once.exceptAll(thrice).count() == 0


def test_unreadable_champion_is_replaced(spark, scratch):
    reg = os.path.join(scratch, "registry")
    REG.append_registry(spark, reg, hdfs_path=os.path.join(scratch, "gone"), version="old", trained_on="x",
                        metrics={"auc": 0.99}, promoted=True, created_at=dt.datetime(2020, 1, 1))
    out = TR.run_training_cycle(spark, adapted_events(spark, SF_MED), os.path.join(scratch, "models"), reg,
                                gap="12 hours", distinct="exact", version="new")
    assert out["promoted"] and out["champion_auc"] is None
    assert REG.active_champion(REG.read_registry(spark, reg)).first().version == "new"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 3)), min_size=1, max_size=60),
       st.integers(1, 70), st.booleans())
def test_first_n_by_time_equals_full_sort(spark, rows, n, newest_first):
    from clickpath.operators.topk import first_n_by_time

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), k) for s, k in rows],
                               "t timestamp, k int")
    t = F.col("t").desc() if newest_first else F.col("t").asc()
    want = sorted(tuple(r) for r in df.orderBy(t, F.col("k")).limit(n).collect())
    got = sorted(tuple(r) for r in first_n_by_time(df, n, "t", [F.col("k")], newest_first).collect())
    assert got == want
