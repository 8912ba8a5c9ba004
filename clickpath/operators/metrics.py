"""Evaluation operators written relationally, so they scale with the data.

* :func:`time_split` cuts the *time range* (not the row count) 60/15/25;
* :func:`class_weights` gives positives the weight neg/pos;
* :func:`threshold_sweep` computes tp/fp/fn for every threshold in one pass:
  each row is binned by how many thresholds it clears, the bins are counted
  (map-side combine, at most T+1 bins × 2 labels), and cumulative sums over
  the bins give every threshold at once;
* :func:`area_under_roc` is the exact rank-sum AUC (ties count one half)
  without a global sort: a prefix sum over ordered bins of the distinct scores
  (one list of bounds, at most ``bins`` values) plus a prefix sum inside each
  bin;
* :func:`classification_metrics` gives accuracy, weighted precision/recall
  and the purchase-class precision/recall from one conditional aggregate.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stage import stage

log = logging.getLogger(__name__)

# Split fractions, sweep grid and promotion margin.
TRAIN_FRAC = 0.60
VAL_FRAC = 0.15
DEFAULT_THRESHOLDS = [round(0.05 * i, 2) for i in range(1, 20)]
PROMOTION_MARGIN = 0.02
AUC_BINS = 1024


@dataclass(frozen=True)
class SplitCutoffs:
    start: int | None
    train_cutoff: int | None
    val_cutoff: int | None


def split_cutoffs(sessions: DataFrame, time_col: str = "session_start",
                  train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC) -> SplitCutoffs:
    """Cutoffs in epoch seconds from the time bounds (one aggregate row)."""
    row = sessions.agg(
        F.min(F.col(time_col).cast("long")).alias("lo"), F.max(F.col(time_col).cast("long")).alias("hi")
    ).first()
    return cutoffs_from_bounds(row["lo"], row["hi"], train_frac, val_frac)


def cutoffs_from_bounds(lo: int | None, hi: int | None, train_frac: float = TRAIN_FRAC,
                        val_frac: float = VAL_FRAC) -> SplitCutoffs:
    """Cut the time range (double arithmetic, truncated to whole seconds)."""
    if lo is None:
        return SplitCutoffs(None, None, None)
    total = hi - lo
    return SplitCutoffs(lo, lo + int(total * train_frac), lo + int(total * (train_frac + val_frac)))


def split_label(sessions: DataFrame, cut: SplitCutoffs, time_col: str = "session_start") -> DataFrame:
    """Adds ``split`` ∈ {train, val, test} (``<=`` cutoffs are inclusive; null without any session)."""
    ts = F.col(time_col).cast("long")
    part = F.when(ts <= F.lit(cut.train_cutoff), "train").when(ts <= F.lit(cut.val_cutoff), "val").otherwise("test")
    return sessions.withColumn("split", part if cut.start is not None else F.lit(None).cast("string"))


def time_split(sessions: DataFrame, time_col: str = "session_start",
               train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC) -> list[DataFrame]:
    """[train, val, test]; an empty input gives three empty frames."""
    labelled = split_label(sessions, split_cutoffs(sessions, time_col, train_frac, val_frac), time_col)
    return [labelled.where(F.col("split") == part).drop("split") for part in ("train", "val", "test")]


def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def class_weight_table(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, n, class_weight), at most a row per class: 1 for negatives, neg/pos for
    positives (1 where there is no positive row).  One aggregate over ``df``."""
    everywhere = Window.partitionBy()  # over at most two rows
    count_of = lambda y: F.coalesce(F.sum(F.when(F.col(label_col) == y, F.col("n"))).over(everywhere), F.lit(0))
    weight = F.when((F.col(label_col) == 1) & (count_of(1) > 0), count_of(0) / count_of(1)).otherwise(F.lit(1.0))
    return class_balance(df, label_col).withColumn("class_weight", weight)


def class_weights(train: DataFrame, label_col: str = "label", weight_col: str = "class_weight") -> DataFrame:
    """Every row with the weight of its class."""
    table = class_weight_table(train, label_col).collect()  # at most two rows
    if len(table) < 2:
        log.warning("the training split lacks a class: %s", [r.asDict() for r in table])
    weight = F.lit(1.0)
    for r in table:
        weight = F.when(F.col(label_col) == r[label_col], F.lit(r["class_weight"])).otherwise(weight)
    return train.withColumn(weight_col, weight)


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def threshold_sweep(scored: DataFrame, label_col: str = "label",
                    score_col: str = "purchase_probability", thresholds=None, group_cols=()) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 for every threshold (``score >= t``).

    With ``group_cols`` one pass sweeps every group (e.g. validation and test
    together); ``pos_total``/``neg_total`` carry the class sizes per group.
    """
    ts = list(DEFAULT_THRESHOLDS if thresholds is None else thresholds)
    if sorted(ts) != ts:
        raise ValueError("thresholds must be ascending")
    g = list(group_cols)
    spark = scored.sparkSession
    score = F.nanvl(F.col(score_col).cast("double"), F.lit(None))  # NaN clears no threshold
    cleared = sum((F.when(score >= F.lit(t), 1).otherwise(0) for t in ts), F.lit(0))
    per_bin = (
        scored.select(*g, cleared.alias("bin"), F.col(label_col).cast("int").alias("y"))
        .groupBy(*g, "bin")
        .agg(
            F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).cast("long").alias("pos"),
            F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).cast("long").alias("neg"),
        )
    )
    # Every bin of every group present (zero rows), so each threshold has a row.
    bins = spark.range(0, len(ts) + 1).select(F.col("id").cast("int").alias("bin"))
    if g:
        bins = (
            per_bin.groupBy(*g).agg(F.sequence(F.lit(0), F.lit(len(ts))).alias("_bins"))
            .select(*g, F.explode("_bins").alias("bin"))
        )
    zero = bins.select(*g, "bin", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"))
    full = zero.unionByName(per_bin).groupBy(*g, "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # At most len(ts)+1 rows per group: these windows are bounded, tiny steps.
    above = Window.partitionBy(*g).orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding,
                                                                             Window.currentRow)
    total = Window.partitionBy(*g)
    grid = F.array(*[F.lit(float(t)) for t in ts])
    out = (
        full.withColumn("tp", F.sum("pos").over(above))
        .withColumn("fp", F.sum("neg").over(above))
        .withColumn("pos_total", F.sum("pos").over(total))
        .withColumn("neg_total", F.sum("neg").over(total))
        .withColumn("fn", F.col("pos_total") - F.col("tp"))
        .filter(F.col("bin") >= 1)
        .withColumn("threshold", F.element_at(grid, F.col("bin")))
    )
    precision = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    out = (
        out.withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    cols = [*g, "threshold", "tp", "fp", "fn", "precision", "recall", "f1"]
    return out.select(*cols, "pos_total", "neg_total") if g else out.select(*cols)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """argmax F1; the lowest threshold wins ties (strict improvement)."""
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


def best_threshold_value(sweep: DataFrame, default: float = 0.5) -> float:
    row = best_threshold(sweep).first()
    return float(row["threshold"]) if row is not None else default


def _bin_of(score: Column, bounds: list[float]) -> Column:
    """How many of the ascending ``bounds`` lie at or below the score, by two short scans instead of a long one."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    pages = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    # the last page is filled up with its own largest bound + infinity, which no score reaches
    pages[-1] += [float("inf")] * (width - len(pages[-1]))
    below = lambda values: F.size(F.filter(values, lambda b: b <= score))
    page = below(F.lit([p[0] for p in pages]))
    inside = below(F.get(F.lit(pages), page - 1))
    return F.when(page == 0, 0).otherwise((page - 1) * width + inside)


def area_under_roc(scored: DataFrame, label_col: str = "label", score_col: str = "purchase_probability",
                   group_cols=(), bins: int = AUC_BINS) -> DataFrame:
    """Exact ROC AUC per group (Mann–Whitney, ties ½); null when a class is absent.

    The rows are counted by distinct score once (written to the shared work
    folder).  Quantiles of the distinct scores give at most ``bins`` bounds,
    and a score's bin is an expression of the score alone, so every use sees
    the same bins.  Negatives below a score are those of earlier bins (a window
    over at most ``bins`` rows per group) plus those below it in its bin (a
    window per bin).  Where the bounds fall affects only the balance, never
    the result.  Null and NaN scores and null labels are left out.
    """
    g = list(group_cols)
    per_score = stage(
        scored.select(*g, F.col(score_col).cast("double").alias("s"), F.col(label_col).cast("int").alias("y"))
        .filter(F.col("s").isNotNull() & ~F.isnan("s") & F.col("y").isNotNull())
        .groupBy(*g, "s")
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")), "auc-scores")
    quantiles = [i / bins for i in range(1, bins)]
    found = per_score.agg(F.percentile_approx("s", quantiles, 10 * bins)).first()[0] or []
    binned = per_score.withColumn("c", _bin_of(F.col("s"), sorted(b for b in set(found) if b != float("inf"))))
    coarse = binned.groupBy(*g, "c").agg(F.sum("neg").alias("cneg"))
    before = Window.partitionBy(*g).orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select(*g, "c", F.coalesce(F.sum("cneg").over(before), F.lit(0)).alias("neg_before_bin"))
    inside = Window.partitionBy(*g, "c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    contrib = (
        binned.withColumn("neg_in_bin", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
        .join(coarse, [*g, "c"])
        .withColumn("neg_below", F.col("neg_before_bin") + F.col("neg_in_bin"))
        .groupBy(*g)
        .agg(
            F.sum(F.col("pos") * F.col("neg_below") + 0.5 * F.col("pos") * F.col("neg")).alias("u"),
            F.sum("pos").alias("n_pos"),
            F.sum("neg").alias("n_neg"),
        )
    )
    denom = F.col("n_pos") * F.col("n_neg")
    return contrib.select(*g, F.when(denom > 0, F.col("u") / denom).alias("auc"), "n_pos", "n_neg")


def classification_metrics(pred: DataFrame, label_col: str = "label",
                           prediction_col: str = "prediction") -> DataFrame:
    """One row: accuracy, weighted precision/recall, class-1 precision/recall, lift."""
    y = F.col(label_col).cast("int")
    p = F.col(prediction_col).cast("int")
    counts = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).alias("fn"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).alias("tn"),
    )
    return metrics_from_confusion(counts)


def metrics_from_confusion(counts: DataFrame, keep=()) -> DataFrame:
    """Metric columns from confusion counts ``n, tp, fp, fn, tn``; ``keep`` columns pass through."""
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    prec1, rec1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    prec0, rec0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    w1, w0 = _safe_div(tp + fn, n), _safe_div(tn + fp, n)
    base_rate = _safe_div(tp + fn, n)
    return counts.select(
        n.alias("n"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        _safe_div(tp + tn, n).alias("accuracy"),
        (w1 * prec1 + w0 * prec0).alias("weighted_precision"),
        (w1 * rec1 + w0 * rec0).alias("weighted_recall"),
        prec1.alias("precision_purchase"),
        rec1.alias("recall_purchase"),
        F.when(base_rate > 0, prec1 / base_rate).alias("lift"),
        *keep,
    )


def promote(challenger_auc: Column, champion_auc: Column, margin: float = PROMOTION_MARGIN) -> Column:
    """No (readable) champion → promote; else strictly more than ``margin`` better."""
    return F.when(champion_auc.isNull(), F.lit(True)).otherwise(
        F.coalesce(challenger_auc - champion_auc > F.lit(margin), F.lit(False))
    )


def should_promote(challenger_auc: float, champion_auc: float | None, margin: float = PROMOTION_MARGIN) -> bool:
    if champion_auc is None:
        return True
    return (challenger_auc - champion_auc) > margin
