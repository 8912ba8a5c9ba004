"""MinHash near-duplicate groups by fast similarity sketching, banding and exact verification.

1. Every text becomes its set of 5-word shingle hashes and a sketch of
   ``COORDINATES`` coordinates (:mod:`clickpath.llm.sketch`).
2. Texts with equal sets form a class; one of them stands for it under the
   class's own number, so a doc_id may stand for several classes.
3. ``COORDINATES / ROWS`` band keys put representatives into buckets.  A pair
   at Jaccard 0.85 shares no bucket with probability (1 - 0.85**4)**24 < 2.1e-8.
4. Buckets are compared in square blocks of at most about ``2 * BLOCK``
   members: first by sketch (a pair is looked at in the first band whose 64-bit
   key it shares, and passes unless its estimate is so low that a pair at the
   threshold has it with probability below ``MISS``), then on the full sets of
   the members that have a partner left.
   A block returns a spanning forest of its links, never all its pairs.
5. Links are joined into components by alternating large-star and small-star
   steps; no step collects links or components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickpath.llm.hashing import mix, shingle_sets, utf8_chunks, word_hashes
from clickpath.llm.sketch import band_keys, sketch_sets
from clickpath.llm.storage import materialize

COORDINATES = 96
ROWS = 4
BLOCK = 512
THRESHOLD_PCT = 85
MISS = 1e-8

_SIGNATURE = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, coords binary"
_BUCKET_ROW = "key long, band int, cell_i int, cell_j int, side int, rep long"


def text_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (null: empty)."""
    out: list[np.ndarray] = []
    for _, data, offsets in utf8_chunks(texts):
        out.extend(shingle_sets(*word_hashes(data, offsets)))
    return out


def _set_digest(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    a = np.array([np.add.reduce(mix(s), dtype=np.uint64) for s in sets], np.uint64)
    b = np.array([np.add.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64) for s in sets], np.uint64)
    return a.view(np.int64), b.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            sets = text_sets(part.column("text"))
            bins = sketch_sets(sets, COORDINATES)
            a, b = _set_digest(sets)
            keys = band_keys(bins, ROWS)
            coords = (bins & np.uint64(0xFFFF)).astype(np.uint16)
            offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(a), pa.array(b), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
                pa.array([row.tobytes() for row in coords], pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "bands", "coords"])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, a 128-bit set digest, band keys and truncated coordinates of every document."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(_signatures, _SIGNATURE)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole runs of equal ``keys`` from batches sorted by them, in pieces of many runs each."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        cols = [table.column(k).to_numpy() for k in keys]
        same_as_last = np.ones(table.num_rows, bool)
        for c in cols:
            same_as_last &= c == c[-1]
        tail = np.flatnonzero(~same_as_last)
        cut = int(tail[-1]) + 1 if len(tail) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def _runs(table: pa.Table, keys: list[str]) -> list[tuple[int, int]]:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in keys:
        c = table.column(k).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(change).tolist()
    return list(zip(starts, starts[1:] + [table.num_rows]))


_CELL = ["key", "cell_i", "cell_j"]


def _first_band_pairs(coords: np.ndarray, keys: np.ndarray, band: int, side: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell whose estimate passes and whose first common band is ``band``.

    The band is that of the bucket keys: coordinates are cut, so equal ones need not mean a common bucket.
    In a cell on the diagonal all members have side 0; else pairs run across the sides.
    """
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    diagonal = not len(right)
    if diagonal:
        right = left
    found_i, found_j = [], []
    for s in range(0, len(left), 64):
        mine = left[s:s + 64]
        equal = coords[mine][:, None, :] == coords[right][None, :, :]
        passes = equal.sum(axis=2) >= need
        if diagonal:
            passes &= mine[:, None] < right[None, :]
        i, j = np.nonzero(passes)
        if not len(i):
            continue
        first = (keys[mine[i]] == keys[right[j]]).argmax(axis=1)
        ok = first == band
        found_i.append(mine[i[ok]])
        found_j.append(right[j[ok]])
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _estimate_floor(threshold_pct: int) -> int:
    """The most equal coordinates that a pair at the threshold falls short of with probability below ``MISS`` (exact binomial)."""
    p = threshold_pct / 100
    below, need = 0.0, 0
    while need < COORDINATES:
        below += math.comb(COORDINATES, need) * p**need * (1 - p) ** (COORDINATES - need)
        if below >= MISS:
            break
        need += 1
    return max(ROWS, need)


def _cell_pairs(table: pa.Table, a: int, b: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    raw = table.column("coords").slice(a, b - a).to_pylist()
    coords = np.frombuffer(b"".join(raw), np.uint16).reshape(b - a, COORDINATES)
    keys = table.column("bands").slice(a, b - a).combine_chunks().flatten().to_numpy().reshape(b - a, -1)
    side = table.column("side").slice(a, b - a).to_numpy()
    return _first_band_pairs(coords, keys, int(table.column("band")[a].as_py()), side, need)


def _promising(threshold_pct: int):
    need = _estimate_floor(threshold_pct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, _CELL):
            table = table.combine_chunks()
            chosen = []
            for a, b in _runs(table, _CELL):
                i, j = _cell_pairs(table, a, b, need)
                if len(i):
                    chosen.append(a + np.unique(np.concatenate([i, j])))
            if chosen:
                out = table.select([c.split()[0] for c in _BUCKET_ROW.split(", ")]).take(pa.array(np.concatenate(chosen)))
                yield from out.combine_chunks().to_batches()

    return run


def _forest(sets: list[np.ndarray], pairs: list[tuple[int, int]], threshold_pct: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that hold on the full sets; busiest members first."""
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    degree = np.bincount(np.array(pairs).reshape(-1), minlength=len(sets))
    links = []
    for i, j in sorted(pairs, key=lambda p: -max(degree[p[0]], degree[p[1]])):
        ri, rj = root(i), root(j)
        if ri == rj:
            continue
        x, y = sets[i], sets[j]
        if 100 * min(len(x), len(y)) < threshold_pct * max(len(x), len(y)):
            continue
        at = np.searchsorted(x, y)
        at[at == len(x)] = 0
        common = int(np.count_nonzero(x[at] == y))
        if 100 * common >= threshold_pct * (len(x) + len(y) - common):
            parent[ri] = rj
            links.append((i, j))
    return links


def _verified(threshold_pct: int):
    need = _estimate_floor(threshold_pct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, _CELL):
            table = table.combine_chunks()
            reps = table.column("rep").to_numpy()
            left, right = [], []
            for a, b in _runs(table, _CELL):
                i, j = _cell_pairs(table, a, b, need)
                if not len(i):
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").slice(a, b - a).to_pylist()]
                for p, q in _forest(sets, list(zip(i.tolist(), j.tolist())), threshold_pct):
                    left.append(reps[a + p])
                    right.append(reps[a + q])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            yield pa.RecordBatch.from_arrays([
                part.column("rep"),
                pa.array([s.tobytes() for s in text_sets(part.column("text"))], pa.binary())], ["rep", "shingles"])


_DIGEST = ["set_a", "set_b", "n_shingles"]


def set_classes(sigs: DataFrame) -> DataFrame:
    """rep (a number of its own), smallest doc_id, that text's hash, bands and coords of every class of equal, non-empty sets."""
    first = F.min(F.struct("doc_id", "text_hash", "bands", "coords")).alias("r")
    return materialize(sigs.where("n_shingles > 0").groupBy(*_DIGEST).agg(first)
                       .select(F.monotonically_increasing_id().alias("rep"), *_DIGEST, "r.*"), "reps")


def near_links(docs: DataFrame, reps: DataFrame, threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """(a, b): links between class numbers whose components are those of all links."""
    rows = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("cells")).cast("int")
    cell_rows = (
        rows.join(shared, "key").withColumn("cells", cells).withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .select("key", "band", F.least("mine", "other").alias("cell_i"), F.greatest("mine", "other").alias("cell_j"),
                F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), "rep"))
    coords = reps.select("rep", "coords", "bands")
    promising = materialize(
        cell_rows.join(coords, "rep").repartition(*_CELL).sortWithinPartitions(*_CELL)
        .mapInArrow(_promising(threshold_pct), _BUCKET_ROW), "cells")
    wanted = reps.select("rep", "doc_id", "text_hash").join(promising.select("rep").distinct(), "rep", "left_semi")
    sets = (docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(wanted, ["doc_id", "text_hash"])
            .select("rep", "text").mapInArrow(_full_sets, "rep long, shingles binary").dropDuplicates(["rep"]))
    return (promising.join(coords, "rep").join(sets, "rep").repartition(*_CELL).sortWithinPartitions(*_CELL)
            .mapInArrow(_verified(threshold_pct), "a long, b long"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links``.

    Alternating large-star and small-star steps; each round is written to the
    shared folder, and the loop ends when a round changes no edge.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        edges = materialize(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == state:
            return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
        state = now


def near_duplicate_groups(docs: DataFrame, threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null and empty texts have no shingles and stand alone; so do rows without a
    doc_id (component_id null, kept true).  Repeated rows share a component and
    get one row each; different texts under one doc_id are linked each by its
    own words.  Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = materialize(signatures(docs), "signatures")
    named = sigs.where("doc_id is not null")
    reps = set_classes(named)
    comps = connected_components(near_links(docs.where("doc_id is not null"), reps, threshold_pct)).withColumnRenamed("node", "rep")
    of = materialize(reps.select("rep", "doc_id", *_DIGEST).join(comps, "rep", "left")
                     .withColumn("component", F.coalesce("component", "rep")), "components")
    smallest = of.groupBy("component").agg(F.min("doc_id").alias("found"), F.count(F.lit(1)).alias("n"))
    # a class that stands alone has its own smallest doc_id; only the linked ones meet their component
    linked = of.join(smallest.where("n > 1").drop("n"), "component", "left")
    classes = linked.select(*_DIGEST, F.coalesce("found", "doc_id").alias("found"))
    return (sigs.select("doc_id", *_DIGEST).join(classes, _DIGEST, "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))
