"""The predictions store: date partitions, pinned batch times, compaction by manifest, counter roll-up.

Layout:

* ``PATH/scored_date=…/run_id=…/batch_id=…`` — what the scoring sink writes;
* ``PATH-store/times/`` — a commit log per run that pins each micro-batch's
  scoring time, so a batch retried after midnight writes the same date again;
* ``PATH-store/compact/version=…/scored_date=…`` — days rewritten into few files;
* ``PATH-store/manifest/`` — a commit log; its newest entry lists the compacted days.

Reports filter on ``scored_date`` beside ``scored_at``, so they read one or two
days, however many there are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor as MON
from ..sources.commits import CommitConflict, commits, latest_commit, read_commit, write_commit
from ..sources.lake import _fs_path, path_exists, read_lake_if_present

PREDICTION_COLUMNS = ("user_session string, event_time timestamp, purchase_probability double, predicted_label boolean, "
                      "model_version string, scored_at timestamp, run_id string, batch_id long, scored_date date")
ROWS_PER_FILE = 5_000_000


def _beside(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/") + "-store", *parts])


def _times(path: str, run_id: str) -> str:
    return _beside(path, "times", run_id)


def batch_time(spark: SparkSession, path: str, run_id: str, batch_id: int, now: dt.datetime | None = None) -> dt.datetime:
    """The scoring time of a micro-batch: the clock at its first attempt, the same at every later one."""
    folder = _times(path, run_id)
    number = batch_id + 1
    now = now or dt.datetime.now(dt.timezone.utc)
    try:
        write_commit(spark, folder, number, {"scored_at": now.isoformat()})
        return now
    except CommitConflict:
        return dt.datetime.fromisoformat(read_commit(spark, folder, number)["scored_at"])


def released_at(spark: SparkSession, path: str, run_id: str, last_batch: int) -> Column:
    """Scoring time of the held batches of a run, up to ``last_batch``, as a column over ``batch_id``.

    Each release pins a time for the batches above the one before, so releasing
    again gives every batch the time of its first release.
    """
    run = f"{run_id}-released"
    batch_time(spark, path, run, last_batch)
    out = None
    for n in sorted(commits(spark, _times(path, run)), reverse=True):  # an entry a release
        at = F.lit(dt.datetime.fromisoformat(read_commit(spark, _times(path, run), n)["scored_at"])).cast("timestamp")
        out = at if out is None else F.when(F.col("batch_id") < n, at).otherwise(out)
    return out


def write_predictions(scored: DataFrame, path: str) -> None:
    """Write scored rows (with ``run_id``, ``batch_id``, ``scored_at``) to their live partitions, replacing those of the same batch."""
    (scored.withColumn("scored_date", F.to_date("scored_at")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("scored_date", "run_id", "batch_id").parquet(path))


def compacted_days(spark: SparkSession, path: str) -> dict[str, str]:
    """{day: folder of its compacted files} by the newest manifest entry."""
    folder = _beside(path, "manifest")
    n = latest_commit(spark, folder)
    return read_commit(spark, folder, n)["days"] if n else {}


def read_predictions(spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """All predictions, or those scored on the days ``since``..``until`` (partition filters), each row once."""
    days = compacted_days(spark, path)
    live = spark.read.schema(PREDICTION_COLUMNS).parquet(path) if path_exists(spark, path) else \
        spark.createDataFrame([], PREDICTION_COLUMNS)
    if days:
        live = live.filter(~F.col("scored_date").isin([dt.date.fromisoformat(d) for d in days]))
    wanted = [f for d, f in sorted(days.items()) if (since is None or d >= since.isoformat()) and (until is None or d <= until.isoformat())]
    out = live
    if wanted:  # the folders of the newest versions only
        base = _beside(path, "compact")
        packed = spark.read.schema(PREDICTION_COLUMNS).option("basePath", base).parquet(*[f"{base}/{f}" for f in wanted])
        out = out.unionByName(packed.select(live.columns))  # without the version, which the paths carry
    if since is not None:
        out = out.filter(F.col("scored_date") >= F.lit(since))
    if until is not None:
        out = out.filter(F.col("scored_date") <= F.lit(until))
    return out


def compact(spark: SparkSession, path: str, before: dt.date, rows_per_file: int = ROWS_PER_FILE, tries: int = 5) -> list[str]:
    """Rewrite every live day before ``before`` into files of ``rows_per_file`` rows and list it in the manifest.

    Only days whose batches are over may be passed: a row written to a
    compacted day later is not read.  The live files stay until
    :func:`remove_compacted`, so running readers are not disturbed; a crash
    before the commit leaves the day live and an unlisted folder.
    """
    live = spark.read.schema(PREDICTION_COLUMNS).parquet(path).filter(F.col("scored_date") < F.lit(before))
    done = compacted_days(spark, path)
    sizes = {r[0].isoformat(): r[1] for r in live.groupBy("scored_date").count().collect()}  # a row a day
    todo = sorted(d for d in sizes if d not in done)
    version = f"v{latest_commit(spark, _beside(path, 'manifest')) + 1}"
    if not todo:
        return []
    files = max(1, sum(sizes[d] for d in todo) // rows_per_file)
    (live.filter(F.col("scored_date").isin([dt.date.fromisoformat(d) for d in todo]))
     .repartitionByRange(files, "scored_date", "scored_at").sortWithinPartitions("scored_date", "scored_at").withColumn("version", F.lit(version))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .option("maxRecordsPerFile", rows_per_file).partitionBy("version", "scored_date").parquet(_beside(path, "compact")))
    for _ in range(tries):
        n = latest_commit(spark, _beside(path, "manifest"))
        days = read_commit(spark, _beside(path, "manifest"), n)["days"] if n else {}
        new = {d: f"version={version}/scored_date={d}" for d in todo if d not in days}
        try:
            write_commit(spark, _beside(path, "manifest"), n + 1, {"days": days | new})
            return sorted(new)
        except CommitConflict:  # another compaction came first: keep its days
            continue
    raise CommitConflict(f"{path}: manifest kept changing")


def remove_compacted(spark: SparkSession, path: str) -> int:
    """Delete the live folders of compacted days; returns their number."""
    n = 0
    for day in compacted_days(spark, path):
        fs, p = _fs_path(spark, f"{path.rstrip('/')}/scored_date={day}")
        n += bool(fs.exists(p) and fs.delete(p, True))
    return n


# --- counters --------------------------------------------------------------------------------------------------

def roll_up(spark: SparkSession, metrics_path: str, rollup_path: str, prune: bool = False) -> dict:
    """Add the per-batch counts above each run's high-water batch to the running totals; returns the new entry.

    The totals are one small entry of a commit log: {run: [high-water batch,
    total, purchases]}.  A batch at or below the mark was counted already, so a
    replayed batch (same rows again) changes nothing.  ``prune`` deletes the
    counted batches, so that a poll lists and reads a bounded number of files.
    """
    while True:
        n = latest_commit(spark, rollup_path)
        runs = read_commit(spark, rollup_path, n)["runs"] if n else {}
        batches = read_lake_if_present(spark, metrics_path)
        if batches is None:
            return runs
        new = _above(batches, runs).groupBy("run_id").agg(F.max("batch_id"), F.sum("total"), F.sum("purchases")).collect()  # a row a run
        if not new:
            return runs
        for run, high, total, purchases in new:
            _, t, p = runs.get(str(run), [-1, 0, 0])
            runs[str(run)] = [int(high), t + int(total), p + int(purchases or 0)]
        try:
            write_commit(spark, rollup_path, n + 1, {"runs": runs})
        except CommitConflict:
            continue
        if prune:
            _prune(spark, metrics_path, runs)
        return runs


def _prune(spark: SparkSession, metrics_path: str, runs: dict) -> None:
    for run, (high, _, _) in runs.items():
        fs, folder = _fs_path(spark, f"{metrics_path.rstrip('/')}/run_id={run}")
        for f in fs.listStatus(folder) if fs.exists(folder) else []:
            name = f.getPath().getName()
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= high:
                fs.delete(f.getPath(), True)


def _above(batches: DataFrame, runs: dict) -> DataFrame:
    ok = ~F.col("run_id").cast("string").isin(list(runs)) if runs else F.lit(True)
    for run, (high, _, _) in runs.items():
        ok = ok | ((F.col("run_id").cast("string") == run) & (F.col("batch_id") > high))
    return batches.filter(ok)


def polled_counters(spark: SparkSession, metrics_path: str, rollup_path: str) -> DataFrame:
    """(metric_key, metric_value): the rolled-up totals and the batches above them."""
    n = latest_commit(spark, rollup_path)
    runs = read_commit(spark, rollup_path, n)["runs"] if n else {}
    rows = [(t, p) for _, t, p in runs.values()]
    totals = spark.createDataFrame(rows, "total long, purchases long")
    batches = read_lake_if_present(spark, metrics_path)
    if batches is not None:
        totals = totals.unionByName(_above(batches, runs).select("total", "purchases"))
    return MON.running_counters(totals)
