"""Event sources: typed CSV scan, raw-text CSV with rejects, JSON decode, cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.sanitize import blank_to_null, parse_event_time, sanitize_double, sanitize_long
from ..schema import CORE_COLUMNS, RAW_TEXT_SCHEMA, WIRE_EVENT_SCHEMA

CORRUPT_COL = "_corrupt_record"


def read_event_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed CSV scan: header, explicit schema (never inferred), time parsed."""
    return (
        spark.read.option("header", "true")
        .schema(WIRE_EVENT_SCHEMA)
        .csv(path)
        .withColumn("event_time", parse_event_time(F.col("event_time")))
    )


def read_event_csv_checked(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """All fields as text plus ``_corrupt_record``, set for lines of wrong arity.

    Nothing is dropped here; :func:`split_rejects` separates the two sides.
    The arity test needs every token of a line, so column pruning is switched
    off for this read (with pruning on, a query that reads only a few columns
    tokenizes only those and never sees a short or long line).
    """
    schema = StructType(RAW_TEXT_SCHEMA.fields + [StructField(CORRUPT_COL, StringType(), True)])
    return (
        spark.read.option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnPruning", "false")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .schema(schema)
        .csv(path)
    )


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted events, sanitized) and (rejected lines with their parsed fields).

    The reject side keeps the text fields beside the raw ``line``: Spark
    refuses scans whose only column is the corrupt-record column, so a query
    over rejects must reference a data column too (``count()`` alone prunes
    to the corrupt column; count with an aggregate over a data column).
    """
    ok = raw.filter(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
    bad = raw.filter(F.col(CORRUPT_COL).isNotNull()).select(F.col(CORRUPT_COL).alias("line"), *CORE_COLUMNS)
    return sanitize_wire(ok), bad


def sanitize_wire(raw: DataFrame) -> DataFrame:
    """Text columns → event schema, with the edge cleaning of the producer."""
    return raw.select(
        parse_event_time(F.trim(F.col("event_time"))).alias("event_time"),
        blank_to_null(F.col("event_type")).alias("event_type"),
        sanitize_long(F.col("product_id")).alias("product_id"),
        sanitize_long(F.col("category_id")).alias("category_id"),
        blank_to_null(F.col("category_code")).alias("category_code"),
        blank_to_null(F.col("brand")).alias("brand"),
        sanitize_double(F.col("price")).alias("price"),
        sanitize_long(F.col("user_id")).alias("user_id"),
        blank_to_null(F.col("user_session")).alias("user_session"),
    )


def decode_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Binary/str JSON message → event columns; bad JSON gives an all-null row.

    The message is decoded inside a generator: a filter on its fields cannot be
    pushed below it, which would parse the JSON again for every field it names.
    """
    event = F.from_json(F.col(value_col).cast("string"), WIRE_EVENT_SCHEMA)
    timed = F.transform(F.array(event), lambda e: e.withField("event_time", parse_event_time(e["event_time"])))
    return messages.select(F.inline(timed))


def clean_events(events: DataFrame) -> DataFrame:
    """The one cleaning step of batch and stream: ``''`` session → null; drop
    rows without event time or session key; keep the 9 core columns."""
    return (
        events.withColumn("user_session", blank_to_null(F.col("user_session")))
        .filter(F.col("event_time").isNotNull() & F.col("user_session").isNotNull())
        .select(*CORE_COLUMNS)
    )


def bounded_replay(events: DataFrame, n: int | None = None) -> DataFrame:
    """The first ``n`` events in time order (ties broken by all columns); no cap by default.

    The cap may be a large share of the table, so the cut is found by minute
    (see ``operators.topk``) over a staged copy of the input.
    """
    from ..operators.topk import first_n_by_time
    from .stage import stage

    if n is None:
        return events
    events = stage(events, "replay")
    tie_break = [F.col(c).asc_nulls_first() for c in CORE_COLUMNS if c != "event_time"]
    return first_n_by_time(events, n, "event_time", tie_break)
