"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a word target.  Whole repeats of the source come first; the
rest of its budget is spread over the exact document lengths in proportion to
their counts, but for the worth of a few of the longest documents; that last
part is fitted by a bounded-knapsack reachability table, so the words taken
meet the target as nearly as whole documents allow.  Which documents of a length are
taken is a seeded draw by hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickpath.llm.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
TABLE = 8
SEED = 20240229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: pd.DataFrame, share: float, cap: float) -> list[float]:
    """Targets for sizes and weights: ``share`` of all words by weight, none above ``cap`` times its size.

    The excess of capped sources goes to the others by weight until none is above.
    """
    limit = cap * sizes["n"].to_numpy(float)
    weight = sizes["weight"].to_numpy(float)
    budget = share * sizes["n"].sum()
    out = np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    while free.any():
        level = (budget - limit[~free].sum()) / weight[free].sum()
        over = free & (weight * level > limit)
        if not over.any():
            out[free] = weight[free] * level
            break
        free &= ~over
    out[~free] = limit[~free]
    return out.tolist()


def subset_sum(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that the sum is as near ``budget`` as can be (the lower one of two as near).

    Bounded counts are split into powers of two, and reachable sums are the
    bits of an integer; the walk back through the tables names the items.
    """
    take = [0] * len(lengths)
    if budget <= 0 or not lengths:
        return take
    limit = budget + max(lengths)
    mask = (1 << (limit + 1)) - 1
    reach, steps = 1, []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        left, part = min(counts[k], limit // lengths[k]), 1
        while left > 0:
            used = min(part, left)
            wider = (reach | (reach << used * lengths[k])) & mask
            if wider != reach:
                steps.append((reach, k, used))
                reach = wider
            left -= used
            part *= 2
        if reach >> budget & 1:
            break
    at = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    if above:
        first = budget + (above & -above).bit_length()
        if first - budget < budget - at:
            at = first
    for earlier, k, used in reversed(steps):
        if not earlier >> at & 1:
            take[k] += used
            at -= used * lengths[k]
    return take


def fit_counts(size: list[int], n: list[int], budget: int) -> list[int]:
    """How many documents of each length meet ``budget``.

    All but about ``TABLE`` of the longest documents' worth is spread in
    proportion to the counts; the knapsack fits the rest from what is left.
    """
    total, table = sum(s * c for s, c in zip(size, n)), TABLE * size[-1]
    if not total or budget <= 0:
        return [0] * len(size)
    take = [c * max(0, budget - table) // total for c in n]
    rest = budget - sum(t * s for t, s in zip(take, size))
    spare = [c - t for c, t in zip(n, take)]
    # the floors leave up to one document of each length: longest first, until the table is small
    for k in range(len(size) - 1, -1, -1):
        more = min(spare[k], max(0, rest - table) // size[k])
        take[k] += more
        spare[k] -= more
        rest -= more * size[k]
    return [t + m for t, m in zip(take, subset_sum(size, spare, rest))]


def fit_lengths(hist: pd.DataFrame) -> pd.DataFrame:
    """Rows (src, size, n, target) of one source -> whole repeats, and how many more documents of each length.

    Where one more round cannot meet the budget, up to two chosen rounds are
    tried, for the last whole repeat if there is one.
    """
    hist = hist[hist["size"] > 0].sort_values("size").reset_index(drop=True)
    if hist.empty:
        return pd.DataFrame({"src": pd.Series(dtype=str), "size": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"),
                             "repeats": pd.Series(dtype="int64"), "extra": pd.Series(dtype="int64")})
    size, n = [int(x) for x in hist["size"]], [int(x) for x in hist["n"]]
    total, target = sum(s * c for s, c in zip(size, n)), int(round(float(hist["target"].iloc[0])))
    best = None
    whole = min(target // total, CAP)
    for repeats, rounds in ((whole, min(1, CAP - whole)), (max(0, whole - 1), min(2, CAP - max(0, whole - 1)))):
        if best and best[0] == 0:
            break
        extra = fit_counts(size, [c * rounds for c in n], target - repeats * total)
        miss = abs(target - repeats * total - sum(e * s for e, s in zip(extra, size)))
        if best is None or miss < best[0]:
            best = miss, repeats, extra
    return pd.DataFrame({"src": hist["src"], "size": size, "n": n, "repeats": best[1], "extra": best[2]})


def source_targets(hist: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(src, source_size, target): one row per source; null is a source, the last one."""
    spark = hist.sparkSession
    # one row per source: the table that assigns weights, not documents
    sizes = hist.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("n")).toPandas()
    sizes["is_null"] = sizes["src"].isna()
    # code point order is the order of UTF-8 bytes
    sizes["by"] = [b"" if s is None else s.encode() for s in sizes["src"].where(~sizes["is_null"], None)]
    sizes = sizes.sort_values(["is_null", "by"]).reset_index(drop=True)
    sizes["weight"] = [weights[i % len(weights)] for i in range(len(sizes))]
    target = water_fill(sizes, share, cap) if len(sizes) else []
    rows = [(None if z else s, int(n), float(t)) for s, z, n, t in zip(sizes["src"], sizes["is_null"], sizes["n"], target)]
    return spark.createDataFrame(rows, "src string, source_size long, target double")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
                seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, repeats, and the columns to carry.

    ``repeats`` is how often the mix takes the document, at most ``cap`` times:
    whole repeats of its source, and more if the draw of its length takes it.  Null and empty
    texts have size 0 and are never taken; a null source is a source of its
    own, after all others; null ids, repeated rows and ties are rows like any
    other.  An empty table gives no rows.  Reruns agree.
    """
    sized = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("src"),
                    word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id").alias("draw"),
                    F.xxhash64("text").alias("tie"), *carry), "mix-sizes")
    hist = sized.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n"))
    targets = source_targets(hist, weights, share, cap)
    same = lambda a, b: a["src"].eqNullSafe(b["src"])
    with_target = (hist.join(targets, same(hist, targets)).select(hist["src"], "size", "n", "target"))
    fitted = materialize(
        with_target.groupBy("src").applyInPandas(fit_lengths, "src string, size long, n long, repeats long, extra long"), "mix-counts")

    # rank inside (source, length) by the draw: bucket totals first, so that one hot length has many tasks
    rows = sized.withColumn("bucket", F.shiftrightunsigned("draw", 56).cast("int"))
    group = ["src", "size", "bucket"]
    totals = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bucket_take = (
        totals.join(fitted, totals["src"].eqNullSafe(fitted["src"]) & (totals["size"] == fitted["size"]))
        .select(totals["src"], totals["size"], "bucket", "base", fitted["n"], "repeats", "extra"))
    in_bucket = Window.partitionBy(*group).orderBy("draw", "doc_id", "tie")
    rows = rows.withColumn("rank", F.row_number().over(in_bucket)).drop("tie", "draw")
    b = bucket_take
    place = F.col("base") + F.col("rank")
    taken = (
        rows.join(b, rows["src"].eqNullSafe(b["src"]) & (rows["size"] == b["size"]) & (rows["bucket"] == b["bucket"]), "left")
        .select("doc_id", rows["src"], rows["size"],
                F.coalesce(F.col("repeats") + (place <= F.col("extra")).cast("long") + (place + F.col("n") <= F.col("extra")).cast("long"),
                           F.lit(0)).alias("repeats"), *carry))
    return (taken.join(targets, same(taken, targets))
            .select("doc_id", taken["src"].alias("source"), "size", "source_size", "target", "repeats", *carry))
