"""The session state of a stream: where it is kept, and what it still holds (open sessions from the state store)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.sessions import DEFAULT_GAP, gap_micros

# Columns of the state value before the distinct-count buffers: the window, then the aggregates in the order of ``event_aggregations``.
_WITH_LABEL = ("label", "session_start", "session_end", "view_count", "cart_count", "remove_count")

_STATE_STORE = "spark.sql.streaming.stateStore"
PROVIDER_KEY = f"{_STATE_STORE}.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# One cache and write buffer for all stores of an executor; no lookup before each write only to count the rows held.
_ROCKSDB_SETTINGS = {f"{_STATE_STORE}.rocksdb.boundedMemoryUsage": "true", f"{_STATE_STORE}.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB (off-heap, spilling to local disk) instead of the executors' heaps.

    A trigger that takes everything there is holds every session until the next
    one closes them.  A provider or setting that the cluster chose stays.  The
    progress of such a stream does not count the rows held.
    """
    chosen = {} if spark.conf.get(PROVIDER_KEY, None) else {PROVIDER_KEY: ROCKSDB, **_ROCKSDB_SETTINGS}
    mine = {k: v for k, v in chosen.items() if spark.conf.get(k, None) is None}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def open_sessions(spark: SparkSession, checkpoint: str, gap: str | int = DEFAULT_GAP, key: str = "user_session",
                  with_label: bool = True, batch_id: int | None = None) -> DataFrame:
    """Sessions that a scoring stream has seen and not yet closed, one row each.

    Read from the committed state of the session operator (``batch_id``:
    after that micro-batch; default: the last one).  The window ends at the
    last event + gap.  Distinct counts stay in the operator's own buffers and
    are not returned; purchase-only sessions are still present.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    value = reader.load(checkpoint).select("value")
    names = [key, "session", *(_WITH_LABEL if with_label else _WITH_LABEL[1:])]
    # aggregates of one function share a field name in the state: a cast renames the fields by position
    fields = value.schema["value"].dataType.fields
    names += [f"_{i}" for i in range(len(fields) - len(names))]
    price_sum, price_n, max_price = names[-3:]
    renamed = StructType([StructField(n, f.dataType) for n, f in zip(names, fields)])
    rows = value.select(F.col("value").cast(renamed).alias("v")).select("v.*")
    names = names[2:-6]
    return rows.select(
        key, F.col("session.start").alias("window_start"),
        # the window is kept up to its end already; the gap is named so that a wrong one is noticed
        F.col("session.end").alias("window_end"), *names,
        F.when(F.col(price_n) > 0, F.col(price_sum) / F.col(price_n)).alias("avg_price"), F.col(max_price).alias("max_price"),
    ).filter(F.unix_micros("window_end") - F.unix_micros("window_start") >= F.lit(gap_micros(gap)))
