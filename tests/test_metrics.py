import itertools
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from clickpath.operators import metrics as M


def scored_df(spark, pairs):
    return spark.createDataFrame([(int(y), float(p)) for y, p in pairs], "label int, purchase_probability double")


def brute_sweep(pairs, t):
    tp = sum(1 for y, p in pairs if p >= t and y == 1)
    fp = sum(1 for y, p in pairs if p >= t and y == 0)
    fn = sum(1 for y, p in pairs if p < t and y == 1)
    pr = tp / (tp + fp) if tp + fp else 0.0
    rc = tp / (tp + fn) if tp + fn else 0.0
    return tp, fp, fn, pr, rc, (2 * pr * rc / (pr + rc) if pr + rc else 0.0)


def test_sweep_matches_per_threshold_loop(spark):
    rnd = random.Random(3)
    pairs = [(rnd.random() < 0.3, round(rnd.random(), 2)) for _ in range(500)]
    got = {r.threshold: (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1)
           for r in M.threshold_sweep(scored_df(spark, pairs)).collect()}
    assert sorted(got) == M.DEFAULT_THRESHOLDS
    for t in M.DEFAULT_THRESHOLDS:
        assert got[t] == pytest.approx(brute_sweep(pairs, t))


def test_best_threshold_ties_and_no_positives(spark):
    # every threshold gives the same F1 → the lowest wins
    flat = scored_df(spark, [(1, 0.99), (0, 0.01)])
    assert M.best_threshold_value(M.threshold_sweep(flat)) == 0.05
    none = scored_df(spark, [(0, 0.7), (0, 0.2)])
    assert M.best_threshold_value(M.threshold_sweep(none)) == 0.05


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_auc_exact_with_ties_and_against_mllib(spark):
    rnd = random.Random(5)
    pairs = [(int(rnd.random() < 0.4), round(rnd.random(), 2)) for _ in range(400)]
    df = scored_df(spark, pairs)
    (r,) = M.area_under_roc(df).collect()
    assert r.auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert (r.n_pos, r.n_neg) == (sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs))
    from pyspark.ml.functions import array_to_vector
    mllib_df = df.select(F.col("label").cast("double").alias("label"),
                         array_to_vector(F.array(1 - F.col("purchase_probability"), F.col("purchase_probability")))
                         .alias("rawPrediction"))
    mllib = BinaryClassificationEvaluator(numBins=0).evaluate(mllib_df)
    assert r.auc == pytest.approx(mllib, abs=1e-9)


def test_auc_grouped_and_degenerate(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 0, 0.5)], "g string, label int, purchase_probability double")
    got = {r.g: r.auc for r in M.area_under_roc(df, group_cols=["g"]).collect()}
    assert got == {"a": 1.0, "b": None}


def test_classification_metrics_match_mllib(spark):
    rnd = random.Random(11)
    rows = [(float(rnd.random() < 0.3), float(rnd.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    (r,) = M.classification_metrics(df).collect()
    ev = MulticlassClassificationEvaluator()
    assert r.accuracy == pytest.approx(ev.setMetricName("accuracy").evaluate(df))
    assert r.weighted_precision == pytest.approx(ev.setMetricName("weightedPrecision").evaluate(df))
    assert r.weighted_recall == pytest.approx(ev.setMetricName("weightedRecall").evaluate(df))
    assert r.precision_purchase == pytest.approx(
        ev.setMetricName("precisionByLabel").setMetricLabel(1.0).evaluate(df))
    assert r.recall_purchase == pytest.approx(ev.setMetricName("recallByLabel").setMetricLabel(1.0).evaluate(df))


def test_time_split_cuts_time_range(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=s), 0) for s in (0, 50, 60, 61, 75, 76, 100)]
    df = spark.createDataFrame(rows, "session_start timestamp, label int")
    train, val, test = M.time_split(df)
    assert (train.count(), val.count(), test.count()) == (3, 2, 2)  # cutoffs 60 and 75, inclusive
    empty = df.limit(0)
    assert [x.count() for x in M.time_split(empty)] == [0, 0, 0]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    assert {r.label: r.class_weight for r in M.class_weights(df).collect()} == {0: 1.0, 1: 3.0}
    table = lambda rows: {tuple(r) for r in M.class_weight_table(spark.createDataFrame(rows, "label int")).collect()}
    assert table([(0,), (1,), (1,)]) == {(0, 1, 1.0), (1, 2, 0.5)}
    assert table([(0,)]) == {(0, 1, 1.0)}   # pos = 0
    assert table([(1,)]) == {(1, 1, 0.0)}   # neg = 0


def test_promotion_rule(spark):
    assert M.should_promote(0.8, None)
    assert not M.should_promote(0.82, 0.80)      # exactly the margin: keep champion
    assert M.should_promote(0.8201, 0.80)
    df = spark.createDataFrame([(0.9, None), (0.81, 0.8), (0.9, 0.8)], "a double, b double")
    assert [r[0] for r in df.select(M.promote(F.col("a"), F.col("b"))).collect()] == [True, False, True]


def test_grouped_sweep_equals_separate_sweeps(spark):
    rnd = random.Random(9)
    rows = [(g, int(rnd.random() < 0.35), round(rnd.random(), 2)) for g in ("val", "test") for _ in range(200)]
    df = spark.createDataFrame(rows, "split string, label int, purchase_probability double")
    grouped = M.threshold_sweep(df, group_cols=["split"])
    for g in ("val", "test"):
        alone = {tuple(r) for r in M.threshold_sweep(df.filter(F.col("split") == g)).collect()}
        part = grouped.filter(F.col("split") == g).drop("split", "pos_total", "neg_total")
        assert {tuple(r) for r in part.collect()} == alone
        (tot,) = grouped.filter(F.col("split") == g).select("pos_total", "neg_total").distinct().collect()
        assert tot.pos_total == sum(1 for s, y, _ in rows if s == g and y == 1)


def test_auc_with_scores_piled_near_zero(spark):
    """Most scores in a sliver near 0 (rare-positive model): still exact."""
    rnd = random.Random(21)
    pairs = [(int(rnd.random() < 0.05), rnd.random() * 1e-4) for _ in range(600)]
    pairs += [(int(rnd.random() < 0.5), rnd.random()) for _ in range(60)]
    (r,) = M.area_under_roc(scored_df(spark, pairs), bins=16).collect()
    assert r.auc == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_on_many_distinct_scores_whatever_the_partitions(spark):
    """1.5 million continuous scores, piled up near 0: equal to MLlib without bins."""
    from pyspark.ml.functions import array_to_vector

    df = spark.range(1_500_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000)) < 80).cast("int").alias("label"),
        F.pow((F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2**40)) / F.lit(float(2**40))), F.lit(6.0)).alias("u"))
    df = df.select("label", (F.col("u") * F.when(F.col("label") == 1, 1.0).otherwise(0.7)).alias("purchase_probability"))
    mllib = BinaryClassificationEvaluator(numBins=0).evaluate(df.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.array(1 - F.col("purchase_probability"), F.col("purchase_probability"))).alias("rawPrediction")))
    for parts, bins in ((3, 1024), (17, 64)):
        (r,) = M.area_under_roc(df.repartition(parts), bins=bins).collect()
        assert r.auc == pytest.approx(mllib, abs=1e-9)


def test_nan_and_null_scores_clear_no_threshold(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, None), (1, 0.9), (0, 0.1)], "label int, purchase_probability double")
    (low,) = M.threshold_sweep(df, thresholds=[0.05]).collect()
    assert (low.tp, low.fp, low.fn) == (1, 1, 2)
    (r,) = M.area_under_roc(df).collect()
    assert (r.auc, r.n_pos, r.n_neg) == (1.0, 1, 1)
