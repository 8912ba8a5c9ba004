"""The first ``n`` rows in time order without an n-per-partition merge.

``orderBy(...).limit(n)`` plans a TakeOrderedAndProject: every input
partition sends its own top ``n`` rows to a single merge task, so the merge
grows with the number of input partitions.  Here rows are counted per
minute (a table bounded by the time span, not by the data), the minute in
which the running count reaches ``n`` is found, every row on the near side
of that minute is taken by a plain filter, and only the remainder is taken,
in full order, from inside that one minute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_by_time(df: DataFrame, n: int, time_col: str, tie_break: list[Column],
                    newest_first: bool = False) -> DataFrame:
    """Exactly the rows of ``df.orderBy(time, *tie_break).limit(n)`` (nulls last)."""
    t = F.col(time_col)
    t_order = t.desc_nulls_last() if newest_first else t.asc_nulls_last()
    order = [t_order, *tie_break]
    minute = F.date_trunc("minute", t)
    m_order = F.col("m").desc_nulls_last() if newest_first else F.col("m").asc_nulls_last()
    per_minute = df.groupBy(minute.alias("m")).agg(F.count(F.lit(1)).alias("k"))
    running = Window.orderBy(m_order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        per_minute.withColumn("upto", F.sum("k").over(running))
        .filter(F.col("upto") >= n)
        .orderBy(m_order)
        .select(F.unix_micros("m").alias("m_us"), (F.col("upto") - F.col("k")).alias("before"))
        .first()
    )
    if cut is None:  # fewer than n rows in total
        return df
    if cut["m_us"] is None:  # the cut falls among rows without a time
        return df.filter(t.isNotNull()).unionByName(df.filter(t.isNull()).orderBy(*order).limit(n - cut["before"]))
    # Epoch microseconds, never a Python datetime (no local-zone round trip).
    start = F.timestamp_micros(F.lit(cut["m_us"]))
    near = df.filter(t >= start + F.expr("INTERVAL 1 MINUTE")) if newest_first else df.filter(t < start)
    edge = df.filter(minute == start).orderBy(*order).limit(n - cut["before"])
    return near.unionByName(edge)
