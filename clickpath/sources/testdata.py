"""Inputs derived from the driver's ``events`` table.

The given table has ``event_id, ts, user_id, event_type, value, props``.  The
adapter maps it onto the event schema:

* ``click`` → ``cart``, ``error`` → ``remove_from_cart``; other types unchanged
  (``signup`` is an unknown type: it counts in distinct/price/time features
  but in no ``*_count``);
* ``k`` of ``props`` is the product; ``k div 10`` the category; brand is
  ``'b' || (k % 7)``, null when ``k % 7 = 0``; price is ``value``; the user id
  is also the session key.

The wire renderings below turn the same rows into the text the producer and
the CSV file carry (dirty tokens included), chosen by fixed rules on ``k`` so
every row is kept and the checks cover the whole table.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import work_path
from ..functions.encode import event_json
from ..schema import CORE_COLUMNS, EVENT_TIME_FORMAT
from .lake import write_complete

# Bump when a derivation below changes, so stale derived files are not reused.
DERIVATION_VERSION = 2

# The event type mapping of the adapter.
TYPE_MAP = {"click": "cart", "error": "remove_from_cart"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    """``k`` of the ``props`` JSON object (typed parse; bad JSON → null)."""
    return F.from_json(F.col("props"), "k bigint").getField("k")


def _event_type() -> Column:
    c = F.col("event_type")
    out = None
    for src, dst in TYPE_MAP.items():
        out = (F.when if out is None else out.when)(c == src, F.lit(dst))
    return out.otherwise(c)


def adapted_events(spark: SparkSession, sf_dir: str, with_id: bool = False,
                   with_k: bool = False) -> DataFrame:
    """``events`` → the 9-column event schema (timestamps in UTC)."""
    k = _k()
    cols = [
        F.col("ts").cast("timestamp").alias("event_time"),
        _event_type().alias("event_type"),
        k.alias("product_id"),
        F.floor(k / 10).cast("bigint").alias("category_id"),
        F.concat(F.lit("c"), F.floor(k / 10).cast("string")).alias("category_code"),
        F.when(F.pmod(k, F.lit(7)) != 0, F.concat(F.lit("b"), F.pmod(k, F.lit(7)).cast("string"))).alias("brand"),
        F.col("value").alias("price"),
        F.col("user_id").alias("user_id"),
        F.col("user_id").cast("string").alias("user_session"),
    ]
    if with_id:
        cols = [F.col("event_id")] + cols
    if with_k:
        cols = cols + [k.alias("k")]
    return table(spark, sf_dir, "events").select(*cols)


def wire_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as producer-side text, with dirty tokens chosen by rules on k."""
    k = _k()
    ks = k.cast("string")
    cat = F.floor(k / 10).cast("bigint")
    value = F.col("value")
    product_raw = (
        F.when(k % 10 == 0, F.lit("n/a"))
        .when(k % 10 == 1, F.concat(ks, F.lit(".0")))
        .when(k % 10 == 2, F.concat(F.lit(" "), ks, F.lit(" ")))
        .when(k % 10 == 3, F.lit("NULL"))
        .when(k % 10 == 4, F.lit("None"))
        .when(k % 10 == 5, F.concat(ks, F.lit(".9")))
        .when(k % 10 == 6, F.concat(F.lit("x"), ks))
        .otherwise(ks)
    )
    category_raw = (
        F.when(k % 4 == 0, F.concat(cat.cast("string"), F.lit(".0")))
        .when(k % 4 == 1, F.lit(""))
        .otherwise(cat.cast("string"))
    )
    user_raw = (
        F.when(F.col("event_type") == "view", (F.col("user_id") + F.lit(2053013555631882000)).cast("string"))
        .when(F.col("event_type") == "signup", F.concat(F.col("user_id").cast("string"), F.lit(".0")))
        .otherwise(F.col("user_id").cast("string"))
    )
    price_raw = (
        F.when(k % 11 == 0, F.lit("NaN"))
        .when(k % 11 == 1, F.lit("inf"))
        .when(k % 11 == 2, F.lit("N/A"))
        .when(k % 11 == 3, F.lit(""))
        .when(k % 11 == 4, F.lit("-Infinity"))
        .when(k % 11 == 5, F.concat(F.lit(" "), value.cast("string"), F.lit(" ")))
        .when(k % 11 == 6, F.lit("abc"))
        .otherwise(value.cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(F.col("ts").cast("timestamp"), EVENT_TIME_FORMAT).alias("event_time"),
        _event_type().alias("event_type"),
        product_raw.alias("product_id"),
        category_raw.alias("category_id"),
        F.when(cat == 0, F.lit("")).otherwise(F.concat(F.lit("c"), cat.cast("string"))).alias("category_code"),
        F.when(F.pmod(k, F.lit(7)) == 0, F.lit("")).otherwise(F.concat(F.lit("b"), F.pmod(k, F.lit(7)).cast("string"))).alias("brand"),
        price_raw.alias("price"),
        user_raw.alias("user_id"),
        F.col("user_id").cast("string").alias("user_session"),
    )


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV lines (no header): good lines, plus by rule 8- and 10-field
    lines, an empty session and a quoted comma inside the brand."""
    adapted = adapted_events(spark, sf_dir, with_k=True)
    k = F.col("k")
    rule = F.pmod(k, F.lit(5)) == 0
    et = F.col("event_type")
    brand = F.coalesce(F.col("brand"), F.lit(""))
    brand_field = F.when(rule & (et == "view"), F.lit('"b,q"')).otherwise(brand)
    session_field = F.when(rule & (et == "purchase"), F.lit("")).otherwise(F.col("user_session"))
    fields = [
        F.date_format("event_time", EVENT_TIME_FORMAT), et,
        F.col("product_id").cast("string"), F.col("category_id").cast("string"),
        F.col("category_code"), brand_field, F.col("price").cast("string"),
        F.col("user_id").cast("string"), session_field,
    ]
    nine = F.concat_ws(",", *fields)
    eight = F.concat_ws(",", *(fields[:5] + fields[6:]))
    ten = F.concat_ws(",", *(fields + [F.lit("extra")]))
    line = (
        F.when(rule & (et == "signup"), eight)
        .when(rule & (et == "remove_from_cart"), ten)
        .otherwise(nine)
    )
    return adapted.select(line.alias("value"))


def _fingerprint(sf_dir: str) -> str:
    """Folder name for derived files: changes when the source table changes."""
    from .lake import _fs_path

    src = f"{sf_dir.rstrip('/')}/events.parquet"
    fs, path = _fs_path(SparkSession.active(), src)  # any store Spark reads
    st = fs.getFileStatus(path)
    files = fs.listStatus(path) if st.isDirectory() else [st]
    stamp = ";".join(sorted(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in files))
    return hashlib.sha1(f"{stamp}:v{DERIVATION_VERSION}".encode()).hexdigest()[:16]


_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def path_lock(path: str) -> threading.Lock:
    """One lock per derived path within this driver."""
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(path, threading.Lock())


def materialized(spark: SparkSession, sf_dir: str, name: str, build, fmt: str, **opts) -> str:
    """Write ``build()`` once into the shared work folder; reuse finished writes.

    Builders running in parallel threads of one driver wait for each other on
    the same path instead of overwriting each other's write.
    """
    path = work_path(spark, _fingerprint(sf_dir), name)
    with path_lock(path):
        if not write_complete(spark, path):
            writer = build().write.mode("overwrite")
            for key, val in opts.items():
                writer = writer.option(key, val)
            getattr(writer, fmt)(path)
    return path


def raw_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw event CSV (header, 9 columns, wire time format)."""
    def build():
        ev = adapted_events(spark, sf_dir)
        return ev.select(
            F.date_format("event_time", EVENT_TIME_FORMAT).alias("event_time"),
            *[c for c in CORE_COLUMNS if c != "event_time"],
        )
    return materialized(spark, sf_dir, "raw_csv", build, "csv", header="true")


def csv_lines_path(spark: SparkSession, sf_dir: str) -> str:
    return materialized(spark, sf_dir, "raw_lines", lambda: csv_lines(spark, sf_dir), "text")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed JSON messages of every event (what sits on the topic)."""
    ev = adapted_events(spark, sf_dir)
    return ev.select(F.col("user_session").alias("key"), event_json(ev).alias("value"))


def edge_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of every event with, by fixed rules on ``k``, broken JSON,
    blank sessions and times that do not parse."""
    ev = adapted_events(spark, sf_dir, with_k=True)
    rule = F.pmod(F.col("k"), F.lit(5)) == 0
    of = lambda name: rule & (F.col("event_type") == name)
    ev = ev.withColumn("user_session", F.when(of("purchase"), F.lit("")).otherwise(F.col("user_session")))
    text = event_json(ev)
    value = (F.when(of("signup"), F.concat(F.lit("{oops "), text))
             .when(of("remove_from_cart"), F.replace(text, F.lit(" UTC"), F.lit(" nowhere"))).otherwise(text))
    return ev.select(F.col("user_session").alias("key"), value.alias("value"))


def messages_path(spark: SparkSession, sf_dir: str) -> str:
    """The JSON message values as text files (one message per line)."""
    return materialized(spark, sf_dir, "messages", lambda: messages(spark, sf_dir).select("value"), "text")
