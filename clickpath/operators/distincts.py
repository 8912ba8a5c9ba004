"""Exact distinct counts by bitmaps over dictionary numbers.

A set of values is awkward to carry and to merge once it is large: it lives in
one row.  Here every value gets a dense number (per kind), and a group's values
become bitmaps of 64 numbers each (8 bytes, built as one long), so a group of a
million values is 15,625 rows that merge by OR, whatever task they meet in, and
a group of a few values takes a few bytes.  Counting is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Dictionary shards: a number is (position inside the shard) * SHARDS + shard, so no shard has to know another's size.
SHARDS = 256
# Copies of the small side of the id join, so that one hot (key, bucket) is read by several tasks.
SALTS = 16
# Fixed value: numbers a bitmap holds (the bits of a long).
BITS = 64


def number_values(values: DataFrame) -> DataFrame:
    """(kind, value, n): a distinct, nearly dense number from 0 for every value of each kind."""
    distinct = values.select("kind", "value").distinct().withColumn("shard", F.pmod(F.xxhash64("value"), F.lit(SHARDS)))
    at = F.row_number().over(Window.partitionBy("kind", "shard").orderBy("value")) - 1
    return distinct.select("kind", "value", (at.cast("long") * SHARDS + F.col("shard")).alias("n"))


def _as_bitmap(word: Column) -> Column:
    return F.unhex(F.lpad(F.hex(word), BITS // 4, "0"))


def value_bitmaps(values: DataFrame, group: list[str]) -> DataFrame:
    """(group…, kind, chunk, bitmap): the values of each group as bitmaps.  ``values``: group…, kind, value (not null)."""
    numbered = values.join(number_values(values), ["kind", "value"])
    bit = F.expr(f"shiftleft(1L, cast(n % {BITS} as int))")
    return (numbered.groupBy(*group, "kind", F.floor(F.col("n") / BITS).alias("chunk")).agg(F.bit_or(bit).alias("word"))
            .select(*group, "kind", "chunk", _as_bitmap(F.col("word")).alias("bitmap")))


def merge_bitmaps(bitmaps: DataFrame, group: list[str]) -> DataFrame:
    """The bitmaps of coarser groups: OR over the finer ones (a dictionary of their own numbers them alike)."""
    word = F.conv(F.hex("bitmap"), 16, -10).cast("long")  # to a negative base: signed
    return (bitmaps.groupBy(*group, "kind", "chunk").agg(F.bit_or(word).alias("word"))
            .select(*group, "kind", "chunk", _as_bitmap(F.col("word")).alias("bitmap")))


def count_bitmaps(bitmaps: DataFrame, group: list[str], kinds: dict[int, str]) -> DataFrame:
    """(group…, one column per kind): distinct values; a kind without values counts 0."""
    n = F.bitmap_count("bitmap")
    return bitmaps.groupBy(*group).agg(*[F.sum(F.when(F.col("kind") == k, n).otherwise(0)).cast("long").alias(name) for k, name in kinds.items()])


def heavy_keys(events: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows (one partial count a key and task is shuffled)."""
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(key)


def with_ids(values: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """``values`` joined to the few ``ids`` rows of their group; each group is spread over ``SALTS`` tasks."""
    salt = F.pmod(F.xxhash64("kind", "value"), F.lit(SALTS)).cast("int")
    copies = ids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return values.withColumn("salt", salt).join(copies, [*on, "salt"]).drop("salt")
