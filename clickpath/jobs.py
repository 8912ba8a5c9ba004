"""Command line jobs: one training cycle, the streaming consumer, monitor reports.

    python -m clickpath.jobs ingest  --raw-csv DIR --rejects DIR (--out DIR | --kafka HOST:PORT --topic NAME)
    python -m clickpath.jobs train   --raw-csv DIR --lake DIR [--stream DIR] --models DIR --registry DIR
    python -m clickpath.jobs consume --source DIR|TOPIC [--kafka HOST:PORT | --source-format csv]
                                     --archive DIR --predictions DIR
                                     --metrics DIR --checkpoints DIR --registry DIR
    python -m clickpath.jobs release --pending DIR --predictions DIR --metrics DIR --registry DIR
    python -m clickpath.jobs monitor --predictions DIR --metrics DIR --registry DIR
    python -m clickpath.jobs compact --predictions DIR --before DATE

Paths are on the cluster's shared file system; checkpoints must be too.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import prepare


def _spark(app: str) -> SparkSession:
    spark = SparkSession.builder.appName(app).getOrCreate()
    return prepare(spark)


def ingest(args) -> dict:
    """Raw CSV → rejected lines (kept and counted) and keyed JSON messages, to files or a topic.

    The counts are this run's: both sides are one parsed input, written under
    the run's own folder.  ``--watch`` follows the folder as a stream instead.
    """
    import uuid

    from .sources.events import bounded_replay, read_event_csv_checked, split_rejects
    from .streaming.ingest import csv_line_stream, ingest_counts, keyed_messages, start_ingest

    spark = _spark("clickpath-ingest")
    if args.watch:
        q = start_ingest(csv_line_stream(spark, args.raw_csv, args.max_files_per_trigger), messages_path=args.out, rejects_path=args.rejects,
                         checkpoint=args.checkpoint, available_now=args.available_now)
        q.awaitTermination()
        out = ingest_counts(spark, args.out, args.rejects).first().asDict()
        print(json.dumps(out))
        return out
    run = uuid.uuid4().hex[:12]
    accepted, rejected = split_rejects(read_event_csv_checked(spark, args.raw_csv))
    messages = keyed_messages(bounded_replay(accepted, args.max_events))
    if args.kafka:
        messages.write.format("kafka").option("kafka.bootstrap.servers", args.kafka).option("topic", args.topic).save()
    else:  # key and value of each message, as on the topic
        messages.write.mode("append").json(args.out)
    path = f"{args.rejects.rstrip('/')}/run_id={run}"
    rejected.write.parquet(path)
    out = {"rejected": spark.read.parquet(path).count()}
    print(json.dumps(out))
    return out


def train(args) -> dict:
    from .plans.training import load_training_events, run_training_cycle

    spark = _spark("clickpath-train")
    events, used = load_training_events(spark, args.raw_csv, args.lake, args.stream, args.dedup, args.rejects)
    out = run_training_cycle(spark, events, args.models, args.registry, model_type=args.model_type,
                             gap=args.gap, trained_on=f"{args.trained_on or args.raw_csv} ({used})",
                             distinct=args.distinct, margin=args.margin)
    print(json.dumps(out, default=str))
    return out


def consume(args) -> None:
    from .streaming.archive import start_archive
    from .streaming.scoring import ChampionCache, start_scoring
    from .streaming.sources import csv_event_stream, event_stream, message_stream

    spark = _spark("clickpath-consume")
    # Session state grows with open sessions: keep it in RocksDB (off-heap,
    # spills to local disk, snapshots to the checkpoint) unless the cluster
    # already chose a provider.  Sessions of a key are merged inside each input
    # partition before the shuffle, so a hot key sends few rows.  Both choices
    # are fixed at the first checkpoint.
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, None):
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    fmt = "kafka" if args.kafka else args.source_format

    def events():
        if fmt == "csv":
            return csv_event_stream(spark, args.source, args.max_files_per_trigger)
        return event_stream(message_stream(spark, args.source, fmt, bootstrap=args.kafka,
                                           max_per_trigger=args.max_per_trigger,
                                           max_files_per_trigger=args.max_files_per_trigger))

    ck = args.checkpoints.rstrip("/")
    once = bool(args.available_now)
    archive = start_archive(events(), args.archive, f"{ck}/archive", args.archive_trigger, available_now=once)
    scoring = start_scoring(events(), champion=ChampionCache(args.registry, args.poll_seconds),
                            predictions_path=args.predictions, metrics_path=args.metrics,
                            checkpoint=f"{ck}/scoring", run_id=args.run_id, gap=args.gap,
                            watermark=args.watermark, distinct=args.distinct, trigger=args.scoring_trigger,
                            available_now=once, pending_path=args.pending, discard_unscored=args.discard_unscored)
    if once:  # catch up on everything available, then exit
        archive.awaitTermination()
        scoring.awaitTermination()
        return
    spark.streams.awaitAnyTermination()


def release(args) -> int:
    from .streaming.scoring import ChampionCache, release_pending

    spark = _spark("clickpath-release")
    n = release_pending(spark, champion=ChampionCache(args.registry), pending_path=args.pending,
                        predictions_path=args.predictions, metrics_path=args.metrics)
    print(json.dumps({"released": n}))
    return n


def monitor(args) -> dict:
    from .operators import monitor as MON
    from .operators import registry as REG
    from .streaming.scoring import rollup_path, running_counters
    from .streaming.store import read_predictions, roll_up

    spark = _spark("clickpath-monitor")
    pred = read_predictions(spark, args.predictions)
    roll_up(spark, args.metrics, rollup_path(args.metrics))
    counters = running_counters(spark, args.metrics)
    as_of = F.lit(args.as_of).cast("timestamp") if args.as_of else F.current_timestamp()
    log = REG.read_registry(spark, args.registry)
    rows = {
        "headline": MON.headline_stats(counters, pred).first().asDict(),
        "avg_probability": MON.avg_probability(pred, as_of).first()[0],
        "trend": [r.asDict() for r in MON.trend(pred, as_of).drop("minute_ts").collect()],
        "recent": [r.asDict() for r in MON.recent_predictions(pred).collect()],
        "champion": (lambda r: r.asDict() if r else None)(REG.active_champion(log).first()),
        "models_trained": log.count(),
        "history": [r.asDict() for r in REG.registry_listing(log).select(
            "version", "short_version", "trained_on", "auc_score", "accuracy", "precision_purchase", "recall_purchase",
            "decision_threshold", "promoted", "is_active", F.col("created_at")).collect()],
    }
    print(json.dumps(rows, default=str))
    return rows


def compact(args) -> list[str]:
    """Rewrite the predictions of closed days into few files and drop the live copies."""
    import datetime as dt

    from .streaming.store import compact as compact_days, remove_compacted

    spark = _spark("clickpath-compact")
    days = compact_days(spark, args.predictions, dt.date.fromisoformat(args.before))
    remove_compacted(spark, args.predictions)
    print(json.dumps({"compacted": days}))
    return days


def main(argv=None):
    p = argparse.ArgumentParser(prog="clickpath")
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("ingest")
    g.add_argument("--raw-csv", required=True)
    g.add_argument("--rejects", required=True)
    g.add_argument("--out")
    g.add_argument("--kafka")
    g.add_argument("--topic")
    g.add_argument("--watch", action="store_true", help="follow --raw-csv as a stream of files (needs --out and --checkpoint)")
    g.add_argument("--checkpoint")
    g.add_argument("--max-files-per-trigger", type=int)
    g.add_argument("--available-now", action="store_true", help="with --watch: take what is there, then exit")
    g.add_argument("--max-events", type=int, help="the first N events in time order; default: all")
    g.set_defaults(fn=ingest)
    t = sub.add_parser("train")
    t.add_argument("--rejects", help="folder for lines of wrong arity")
    t.add_argument("--raw-csv", required=True)
    t.add_argument("--lake", required=True)
    t.add_argument("--stream")
    t.add_argument("--models", required=True)
    t.add_argument("--registry", required=True)
    t.add_argument("--model-type", default="logistic_regression")
    t.add_argument("--gap", default="30 minutes")
    t.add_argument("--distinct", default="sketch", choices=["exact", "sketch", "hllpp"])
    t.add_argument("--dedup", default="stream", choices=["stream", "all", "none"])
    t.add_argument("--margin", type=float, default=0.02)
    t.add_argument("--trained-on")
    t.set_defaults(fn=train)
    c = sub.add_parser("consume")
    c.add_argument("--source", required=True)
    c.add_argument("--kafka")
    c.add_argument("--source-format", default="text", choices=["text", "keyed", "csv"],
                   help="text: one JSON message per line; keyed: key and value per line, as ingest writes; csv: raw event CSV files with a header")
    c.add_argument("--archive", required=True)
    c.add_argument("--predictions", required=True)
    c.add_argument("--metrics", required=True)
    c.add_argument("--checkpoints", required=True)
    c.add_argument("--registry", required=True)
    c.add_argument("--pending", help="folder for sessions closed while there is no champion")
    c.add_argument("--discard-unscored", action="store_true", help="drop those sessions instead")
    c.add_argument("--run-id")
    c.add_argument("--gap", default="30 minutes")
    c.add_argument("--watermark", default="30 minutes")
    c.add_argument("--distinct", default="sketch", choices=["exact", "sketch", "hllpp"])
    c.add_argument("--max-per-trigger", type=int, default=30000)
    c.add_argument("--max-files-per-trigger", type=int)
    c.add_argument("--archive-trigger", default="60 seconds")
    c.add_argument("--scoring-trigger", default="30 seconds")
    c.add_argument("--poll-seconds", type=float, default=30)
    c.add_argument("--available-now", action="store_true",
                   help="process everything available in both queries, then exit")
    c.set_defaults(fn=consume)
    r = sub.add_parser("release", help="score sessions held while no champion existed")
    r.add_argument("--pending", required=True)
    r.add_argument("--predictions", required=True)
    r.add_argument("--metrics", required=True)
    r.add_argument("--registry", required=True)
    r.set_defaults(fn=release)
    m = sub.add_parser("monitor")
    m.add_argument("--predictions", required=True)
    m.add_argument("--metrics", required=True)
    m.add_argument("--registry", required=True)
    m.add_argument("--as-of", help="end of the trend window as a timestamp; default: now")
    m.set_defaults(fn=monitor)
    k = sub.add_parser("compact", help="rewrite the predictions of closed days into few files")
    k.add_argument("--predictions", required=True)
    k.add_argument("--before", required=True, help="first day that stays as it is (YYYY-MM-DD)")
    k.set_defaults(fn=compact)
    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    main()
