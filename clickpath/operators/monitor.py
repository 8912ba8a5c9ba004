"""Monitor queries over the predictions and counters tables.

All time windows take an explicit ``as_of`` instead of the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Window length, trend label format, recent-list length.
TREND_MINUTES = 30
MINUTE_LABEL = "MM-dd HH:mm"
RECENT_ROWS = 20
COUNTER_KEYS = ("total_predictions", "purchase_predicted")


def _as_of(as_of) -> Column:
    """A Column, epoch microseconds (int, preferred: no local-zone round trip) or a datetime."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, int):
        return F.timestamp_micros(F.lit(as_of))
    return F.lit(as_of).cast("timestamp")


def _since(as_of, minutes: int) -> Column:
    return F.col("scored_at") >= _as_of(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def _window(predictions: DataFrame, as_of, minutes: int) -> DataFrame:
    """The last ``minutes`` before ``as_of``; where the table is laid out by ``scored_date``, from those days' partitions alone."""
    rows = predictions.filter(_since(as_of, minutes))
    if "scored_date" in predictions.columns:
        rows = rows.filter(F.col("scored_date") >= F.to_date(_as_of(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")))
    return rows


def batch_metrics(predictions: DataFrame, batch_col="batch_id") -> DataFrame:
    """Per scoring batch (one column or a list): rows written and predicted purchases."""
    cols = [batch_col] if isinstance(batch_col, str) else list(batch_col)
    return predictions.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("predicted_label").cast("int")).cast("long").alias("purchases"),
    )


def headline_of(predictions: DataFrame) -> DataFrame:
    """The headline straight from the predictions, in one aggregate."""
    return _headline(predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(F.col("predicted_label")).alias("purchase_predicted"),
        F.max("scored_at").alias("latest_scored_at")))


def running_counters(batches: DataFrame) -> DataFrame:
    """The two running counters as (metric_key, metric_value), 0 when empty."""
    totals = batches.agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("long").alias("total_predictions"),
        F.coalesce(F.sum("purchases"), F.lit(0)).cast("long").alias("purchase_predicted"),
    )
    return totals.select(
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("metric_key"), F.col(k).alias("metric_value")) for k in COUNTER_KEYS
        ])).alias("m")
    ).select("m.*")


def headline_stats(counters: DataFrame, predictions: DataFrame) -> DataFrame:
    """Totals, complement, rate (0 when empty) and the latest scoring time.

    Counters and predictions are stacked and reduced in one aggregate (no join).
    """
    stacked = counters.select(
        "metric_key", F.col("metric_value").cast("long").alias("metric_value"),
        F.lit(None).cast("timestamp").alias("scored_at"),
    ).unionByName(predictions.select(
        F.lit(None).cast("string").alias("metric_key"), F.lit(None).cast("long").alias("metric_value"),
        F.col("scored_at").cast("timestamp").alias("scored_at"),
    ))
    c = stacked.agg(
        F.coalesce(F.max(F.when(F.col("metric_key") == "total_predictions", F.col("metric_value"))), F.lit(0))
        .cast("long").alias("total_predictions"),
        F.coalesce(F.max(F.when(F.col("metric_key") == "purchase_predicted", F.col("metric_value"))), F.lit(0))
        .cast("long").alias("purchase_predicted"),
        F.max("scored_at").alias("latest_scored_at"),
    )
    return _headline(c)


def _headline(totals: DataFrame) -> DataFrame:
    total, purchase = F.col("total_predictions"), F.col("purchase_predicted")
    rate = F.when(total > 0, purchase / total * 100).otherwise(F.lit(0.0))
    return totals.select(
        total, purchase, (total - purchase).alias("no_purchase_predicted"),
        rate.alias("purchase_rate"), F.round(rate, 2).alias("purchase_rate_api"), "latest_scored_at",
    )


def avg_probability(predictions: DataFrame, as_of, minutes: int = TREND_MINUTES) -> DataFrame:
    """Mean probability over the last ``minutes`` before ``as_of``; 0.0 if none."""
    return _window(predictions, as_of, minutes).agg(
        F.coalesce(F.avg("purchase_probability"), F.lit(0.0)).alias("avg_probability"))


def trend(predictions: DataFrame, as_of, limit_minutes: int = TREND_MINUTES) -> DataFrame:
    """Per-minute volume, purchases and rate for the newest ``limit_minutes`` buckets."""
    buckets = (
        _window(predictions, as_of, limit_minutes)
        .groupBy(F.date_trunc("minute", "scored_at").alias("minute_ts"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count(F.when(F.col("predicted_label"), 1)).alias("purchases"),
        )
        .orderBy(F.col("minute_ts").desc())
        .limit(limit_minutes)
    )
    return buckets.orderBy("minute_ts").select(
        "minute_ts",
        F.date_format("minute_ts", MINUTE_LABEL).alias("minute"),
        "total", "purchases",
        F.when(F.col("total") > 0, F.round(F.col("purchases") / F.col("total") * 100, 1))
        .otherwise(F.lit(0.0)).alias("purchase_rate"),
    )


def recent_predictions(predictions: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    """Newest ``n`` rows (ties broken by session and event time).

    Where the table is laid out by ``scored_date``, only the newest days that
    hold ``n`` rows are read: their number comes from the row counts by day,
    which the files' footers answer.
    """
    if "scored_date" in predictions.columns:
        per_day = predictions.groupBy("scored_date").count().orderBy(F.col("scored_date").desc())
        first, seen = None, 0
        for day, rows in per_day.limit(n).collect():  # at most n days
            first, seen = day, seen + rows
            if seen >= n:
                break
        predictions = predictions.filter(F.col("scored_date") >= F.lit(first))
    return predictions.orderBy(F.col("scored_at").desc(), F.col("user_session").asc(), F.col("event_time").desc()).limit(n) \
        .select("user_session", "purchase_probability", "predicted_label", "model_version", "scored_at")


def as_of_latest(predictions: DataFrame) -> int | None:
    """Newest ``scored_at`` as epoch microseconds (None when empty)."""
    return predictions.agg(F.max(F.unix_micros("scored_at"))).first()[0]
