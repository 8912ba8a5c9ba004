"""Sink 1: every clean event appended to the Parquet lake by type and date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import CORE_COLUMNS

# Fixed value: archive trigger interval of the reference deployment.
ARCHIVE_TRIGGER = "60 seconds"


def start_archive(events: DataFrame, path: str, checkpoint: str, trigger: str | None = ARCHIVE_TRIGGER,
                  available_now: bool = False, partition_by=("event_type", "event_date"),
                  dedup_within: str | None = None) -> StreamingQuery:
    """``dedup_within``: an event (all 9 columns) that comes again within this delay is archived once; a key stays
    in the state only until the watermark passes it, so the state is bounded by the delay."""
    if dedup_within is not None:
        events = events.withWatermark("event_time", dedup_within).dropDuplicatesWithinWatermark(CORE_COLUMNS)
    out = events.withColumn("event_date", F.to_date("event_time"))
    writer = (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()
