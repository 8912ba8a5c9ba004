"""Streaming ingest: raw CSV lines → keyed JSON messages and a reject side.

Each micro-batch of dropped files is parsed once, with the corrupt-record
column, and written to two idempotent sinks: accepted events as keyed messages
and lines of wrong arity as rejects, both in partitions ``run_id=…/batch_id=…``
(a retried batch replaces its own rows, so it is counted once).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.encode import event_json
from ..schema import RAW_TEXT_SCHEMA
from ..sources.events import CORRUPT_COL, split_rejects
from .scoring import _write_partitioned, run_id_for

# Fixed value: ingest trigger interval.
INGEST_TRIGGER = "30 seconds"


def csv_line_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None, header: bool = True) -> DataFrame:
    """Raw CSV files dropped into a folder, all fields as text, lines of wrong arity marked."""
    schema = StructType(RAW_TEXT_SCHEMA.fields + [StructField(CORRUPT_COL, StringType(), True)])
    reader = (spark.readStream.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE")
              .option("columnPruning", "false").option("columnNameOfCorruptRecord", CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source)


def keyed_messages(accepted: DataFrame) -> DataFrame:
    return accepted.select(F.col("user_session").alias("key"), event_json(accepted).alias("value"))


def ingest_batch(batch: DataFrame, batch_id: int, *, messages_path: str, rejects_path: str, run_id: str) -> tuple[int, int]:
    """Write one micro-batch to both sinks; returns (messages, rejects) of this batch."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        accepted, rejected = split_rejects(batch)
        tag = [F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id")]
        _write_partitioned(keyed_messages(accepted).select("*", *tag), messages_path)
        _write_partitioned(rejected.select("*", *tag), rejects_path)
        n, bad = batch.agg(F.count(F.lit(1)), F.count(CORRUPT_COL)).first()
        return n - bad, bad
    finally:
        batch.unpersist()


def start_ingest(lines: DataFrame, *, messages_path: str, rejects_path: str, checkpoint: str, run_id: str | None = None,
                 trigger: str | None = INGEST_TRIGGER, available_now: bool = False,
                 after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """``after_write(batch_id)`` runs between the sink writes and the commit of the batch."""
    run_id = run_id or run_id_for(checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, messages_path=messages_path, rejects_path=rejects_path, run_id=run_id)
        if after_write is not None:
            after_write(batch_id)

    writer = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def ingest_counts(spark: SparkSession, messages_path: str, rejects_path: str) -> DataFrame:
    """(n_messages, n_keys, n_rejected) over all batches."""
    messages = spark.read.parquet(messages_path).select("key", F.lit(0).alias("bad"))
    rejects = spark.read.parquet(rejects_path).select(F.lit(None).cast("string").alias("key"), F.lit(1).alias("bad"))
    rows = messages.unionByName(rejects)
    return rows.agg(F.count_if(F.col("bad") == 0).alias("n_messages"), F.count_distinct("key").alias("n_keys"),
                    F.count_if(F.col("bad") == 1).alias("n_rejected"))
