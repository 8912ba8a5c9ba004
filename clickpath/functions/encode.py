"""Event → keyed JSON message (what the producer puts on the topic)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CORE_COLUMNS, EVENT_TIME_FORMAT


def event_json(df: DataFrame, time_format: str = EVENT_TIME_FORMAT) -> Column:
    """JSON object of the 9 core columns with explicit nulls, times as wire text."""
    fields = [
        F.date_format("event_time", time_format).alias("event_time")
        if c == "event_time" else F.col(c)
        for c in CORE_COLUMNS
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
