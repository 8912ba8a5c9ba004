"""Ranked lexical search, term at a time with limited accumulators.

One pass turns every text into its postings (query term, occurrences) and its
length; they are written once, and the collection figures N, L and df are
plain aggregates of them.  A second pass scores shards of documents.  In a
shard an item takes its terms rarest first.  Each term's postings add to the
accumulators of their documents; once the terms that are left cannot lift a
new document to the k-th best partial score, no accumulator is created any
more, and the existing ones are still updated exactly.  The best k of each
shard and item meet in two ranking steps.

Items are searched in groups of at most ``GROUP_TERMS`` distinct terms (a
longer item is a group of its own), so what travels with the tasks is bounded.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickpath.llm.storage import materialize

TOP = 50
GROUP_TERMS = 50_000
SHARD_DOCS = 8_192
SALTS = 64

_SEGMENT = 1 << 20
# bytes of terms: ASCII letters and digits and all of other characters; A-Z in lower case, the rest a space
_TABLE = bytes((c | 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
_HITS = "item_id long, doc_id long, score long"


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term; long texts are cut at separators."""
    if len(text) <= _SEGMENT:
        return Counter(text.translate(_TABLE).split())
    out: Counter = Counter()
    at = 0
    while at < len(text):
        part = text[at:at + _SEGMENT].translate(_TABLE)
        at += len(part)
        while at < len(text):  # the rest of the last term
            more = text[at:at + 4096].translate(_TABLE)
            end = more.find(b" ")
            part += more if end < 0 else more[:end]
            at += len(more) if end < 0 else end
            if end >= 0:
                break
        out.update(part.split())
    return out


def _postings(number: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, tfs, offsets = [], [], [], [0]
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                counts = count_terms(text or b"")
                sizes.append(sum(counts.values()))
                mine = [(number[t], n) for t, n in counts.items() if t in number]
                terms.extend(t for t, _ in mine)
                tfs.extend(n for _, n in mine)
                offsets.append(len(terms))
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    return run


def best_of_shard(items: list[list[int]], start: np.ndarray, doc: np.ndarray, gain: np.ndarray, most: np.ndarray, weight: list[int],
                  n_docs: int, order: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(item, documents, scores, accumulators) of the best ``k`` documents of a shard for each item.

    The postings of term t are ``doc`` and ``gain`` (what it adds to a score)
    from ``start[t]`` to ``start[t + 1]``; ``most[t]`` is its largest gain here
    and ``order`` the rank of each document among equal scores.
    """
    score = np.zeros(n_docs, np.int64)
    has = np.zeros(n_docs, bool)
    for item, terms in enumerate(items):
        terms = sorted((t for t in terms if start[t] < start[t + 1]), key=lambda t: (-weight[t], t))
        left = sum(int(most[t]) for t in terms)  # what the terms from here on can add
        made: list[np.ndarray] = []
        count, open_ = 0, True
        for t in terms:
            d, g = doc[start[t]:start[t + 1]], gain[start[t]:start[t + 1]]
            if open_ and count >= k:
                live = np.concatenate(made)
                made = [live]
                partial = score[live]
                open_ = left >= int(partial[np.argpartition(-partial, k - 1)[k - 1]])
            old = has[d]
            if open_:
                new = d[~old]
                has[new] = True
                made.append(new)
                count += len(new)
                score[d] += g
            else:
                score[d[old]] += g[old]
            left -= int(most[t])
        if not made:
            continue
        live = np.concatenate(made)
        s = score[live]
        some = live[s > 0]
        best = some[np.lexsort((order[some], -score[some]))[:k]]
        yield item, best, score[best].copy(), count
        score[live] = 0
        has[live] = False


def _search(names: list[int], items: list[list[int]], weight: list[int], total: int, length: int, k: int, shard_docs: int):
    weights = np.array(weight, np.int64)

    def shard(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        n = table.column("n").to_numpy()
        lists = table.column("terms").combine_chunks()
        terms = lists.flatten().to_numpy()
        tf = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
        docs = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        m = 50 + (50 * n * total) // length
        by_term = np.argsort(terms, kind="stable")
        terms, tf, docs = terms[by_term], tf[by_term], docs[by_term]
        start = np.searchsorted(terms, np.arange(len(weights) + 1))
        gain = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[docs]))
        most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(start))
        if len(held):
            most[held] = np.maximum.reduceat(gain, start[held])
        order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
        rank = np.empty(len(n), np.int64)
        rank[order] = np.arange(len(n))
        item, best, scores = [], [], []
        for i, d, s, _ in best_of_shard(items, start, docs, gain, most, weight, len(n), rank, k):
            item.append(np.full(len(d), names[i], np.int64))
            best.append(d)
            scores.append(s)
        if item:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(item)), ids.take(pa.array(np.concatenate(best))), pa.array(np.concatenate(scores))],
                                             ["item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= shard_docs:
                yield from shard(held)
                held, rows = [], 0
        if rows:
            yield from shard(held)

    return run


def weight_of(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def _groups_of(items: list[tuple[int, list[bytes]]], limit: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items in groups whose distinct terms number at most ``limit``, or single items."""
    group: list[tuple[int, list[bytes]]] = []
    seen: set[bytes] = set()
    for item, terms in items:
        if group and len(seen | set(terms)) > limit:
            yield group
            group, seen = [], set()
        group.append((item, terms))
        seen |= set(terms)
    if group:
        yield group


def rank_documents(docs: DataFrame, benchmark: DataFrame, k: int = TOP, group_terms: int = GROUP_TERMS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The best ``k`` documents of every benchmark item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of all other non-ASCII
    characters, A-Z in lower case.  Null and empty texts have no terms and are
    found by nothing.  Rows of one item_id are one item with the terms of all
    of them; rows without an item_id cannot be named and are left out.
    Repeated documents are ranked one by one, those without a doc_id last
    among equal scores.  An empty table on either side gives no rows.  The
    items are the stated query set and come to the driver; other columns are
    not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    own: dict[int, set[bytes]] = {}
    for item, text in benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null").toLocalIterator():
        own.setdefault(item, set()).update(count_terms(text.encode()))
    items = [(i, sorted(t)) for i, t in sorted(own.items()) if t]
    found = None
    for group in _groups_of(items, group_terms):
        words = sorted({t for _, terms in group for t in terms})
        number = {t: i for i, t in enumerate(words)}
        postings = materialize(docs.mapInArrow(_postings(number), _POSTINGS).where("n > 0"), "postings")
        total, length = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not total:
            break
        df = [0] * len(words)
        for t, n in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per query term
            df[t] = n
        weight = [weight_of(total, n) for n in df]
        lists = [[number[t] for t in terms] for _, terms in group]
        hits = postings.mapInArrow(_search([i for i, _ in group], lists, weight, total, length, k, shard_docs), _HITS)
        best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        # first among the hits of one salt, so that no item's hits of all shards meet in one task
        hits = (hits.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
                .withColumn("r", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best))).where(F.col("r") <= k)
                .withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).where(F.col("rank") <= k))
        rows = hits.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        found = rows if found is None else found.unionByName(rows)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
