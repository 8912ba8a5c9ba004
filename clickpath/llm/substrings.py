"""Removal of repeated word windows by recompression.

1. Every text is recompressed (:mod:`clickpath.llm.recompress`): rounds name
   runs and pairs of words, of names, of names of names.  Equal windows share
   their inner symbols.
2. Two kinds of marks leave each text.  The *label* of the longest sure symbol
   of some window reveals: a window whose label is found once in all texts is
   found once.  The *span* of a symbol, a 96-bit hash of its words and the
   ``window - 1`` words behind, verifies: if it is found twice, so are all
   windows that start in the symbol.
3. Marks meet in one range partition over their hashes, with the block of
   their document as a further key, so a passage that a third of the documents
   hold spreads over many ranges; only a verdict for the block comes back.
4. Windows that a label reveals and no span verifies (the rims of a repeat)
   are verified one by one by their own hashes in the same way.  A window of a
   verified span meets them through one holder of the span, if its label is
   found more often than the span.

A block is the documents of one hash value, about ``BLOCK_BYTES`` of text.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickpath.llm.hashing import utf8_chunks, word_hashes
from clickpath.llm.neardup import _groups
from clickpath.llm.recompress import Parse, SpanHash, cores, labels, longest_symbols, parse
from clickpath.llm.storage import materialize

WINDOW = 35
BLOCK_BYTES = 4 << 20

_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_SEGMENT = 1 << 20
_FOUND = "kind int, pid long, start int, h0 long, h1 int, n long, doc_id long, text binary, n_words long, n_removed long, repeated binary, kept_sha256 string"


def _narrow(h: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of a span hash; the second part is odd (a label has 0 there)."""
    return h[0], (h[1] >> 32).astype(np.int32) | np.int32(1)


class _Piece:
    """Symbols, marks and windows of a few texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.words, self.bounds = word_hashes(data, offsets, lower=False)
        self.window = window
        self.parse: Parse = parse(self.words, self.bounds)
        self.hash = SpanHash(self.words)
        ends = np.repeat(self.bounds[1:], np.diff(self.bounds))
        #: first word of every window
        self.first = np.flatnonzero(np.arange(len(self.words)) + window <= ends)
        #: label of every window, as a symbol (-1: no sure symbol)
        self.symbol = longest_symbols(self.parse, *cores(self.parse, self.first, window))
        # spans: symbols in which a window starts
        end = self.bounds[1:][self.parse.rows]
        start = self.parse.starts[:-1]
        self.spans = np.flatnonzero(start + window <= end)
        self.span_ends = np.minimum(self.parse.starts[1:][self.spans] + window - 1, end[self.spans])

    def label_hashes(self) -> np.ndarray:
        return labels(self.parse).view(np.int64)

    def span_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        return _narrow(self.hash(self.parse.starts[:-1][self.spans], self.span_ends))


def _pieces(texts: pa.Array, window: int) -> Iterator[tuple[int, int, _Piece]]:
    """(first row, rows, piece) over a batch of texts."""
    for row, data, offsets in utf8_chunks(texts):
        yield row, len(offsets) - 1, _Piece(data, offsets, window)


def _marks(window: int):
    """Distinct (hash, block) of the labels and spans of each piece, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            for row, n, p in _pieces(batch.column("text"), window):
                used = np.unique(p.symbol[p.symbol >= 0])
                s0, s1 = p.span_hashes()
                h0 = np.concatenate([p.label_hashes()[used], s0])
                h1 = np.concatenate([np.zeros(len(used), np.int32), s1])
                at = block[row:row + n][p.parse.rows[np.concatenate([used, p.spans])]]
                order = np.lexsort((at, h1, h0))
                h0, h1, at = h0[order], h1[order], at[order]
                new = np.ones(len(h0), bool)
                new[1:] = (h0[1:] != h0[:-1]) | (h1[1:] != h1[:-1]) | (at[1:] != at[:-1])
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(h0)))
                yield pa.RecordBatch.from_arrays([pa.array(h0[first]), pa.array(h1[first]), pa.array(count), pa.array(at[first])],
                                                 ["h0", "h1", "n", "block"])

    return run


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted runs of (h0, h1) with the run's total: kind 0 repeated; 1 a run at an end of the range; 2 a row of such a run."""
    held: pa.Table | None = None
    first = True

    def settle(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal first
        table = table.combine_chunks()
        h0, h1, n = (table.column(c).to_numpy() for c in ("h0", "h1", "n"))
        new = np.ones(len(h0), bool)
        new[1:] = (h0[1:] != h0[:-1]) | (h1[1:] != h1[:-1])
        starts = np.flatnonzero(new)
        total = np.add.reduceat(n.astype(np.int64), starts)
        is_open = np.zeros(len(starts), bool)
        is_open[0] |= first
        is_open[-1] |= last
        first = False
        run = np.cumsum(new) - 1
        for kind, rows in ((0, np.flatnonzero((~is_open & (total > 1))[run])), (1, starts[is_open]), (2, np.flatnonzero(is_open[run]))):
            if len(rows):
                part = table.take(pa.array(rows))
                part = part.set_column(part.column_names.index("n"), "n", pa.array(total[run[rows]]))
                part = part.add_column(0, "lead", pa.array(new[rows]))
                part = part.add_column(0, "kind", pa.array(np.full(len(rows), kind, np.int32))).combine_chunks()
                yield from (pa.RecordBatch.from_arrays(b.columns, part.column_names) for b in part.to_batches())

    for table in _groups(batches, ["h0", "h1"]):
        if held is not None:
            yield from settle(held, False)
        held = table
    if held is not None:
        yield from settle(held, True)


def repeated(rows: DataFrame, payload: list[str], parts: int) -> DataFrame:
    """(h0, h1, *payload, n, lead): the rows whose hash has a total ``n`` of two or more over all rows.

    ``lead`` marks at least one row of each hash.  ``rows``: a written table with a long ``n``.
    """
    schema = rows.select("h0", "h1", "n", *payload).schema
    out = "kind int, lead boolean, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    order = ["h0", "h1", *payload]
    decided = materialize(
        rows.select(*schema.names).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_verdicts, out), "verdicts")
    # two rows a range at most
    settled = decided.where("kind = 1").groupBy("h0", "h1").agg(F.sum("n").alias("n")).where("n > 1")
    late = decided.where("kind = 2").drop("n").join(F.broadcast(settled), ["h0", "h1"])
    columns = ["h0", "h1", *payload, "n", "lead"]
    return decided.where("kind = 0").select(columns).unionByName(late.select(columns))


def kept_sha256(text: bytes, keep: np.ndarray | None) -> str:
    """SHA-256 of the words that stay, joined by one space; the text is split a segment at a time."""
    digest = hashlib.sha256()
    at = word = 0
    glue = b""
    while at < len(text):
        end = len(text)
        if end - at > _SEGMENT:
            space = _SPACE.search(text, at + _SEGMENT)
            end = space.end() if space else end
        words = text[at:end].split()
        n = len(words)
        if keep is not None:
            words = list(compress(words, keep[word:word + n].tolist()))
        if words:
            digest.update(glue + b" ".join(words))
            glue = b" "
        at, word = end, word + n
    return digest.hexdigest()


def _keep(n_words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Words outside all windows that start at ``starts``."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change)[:-1] == 0


def _removed(keep: np.ndarray) -> tuple[int, bytes | None]:
    """(number, compressed bitmap) of the words that go; no bitmap if none goes."""
    n = len(keep) - int(keep.sum())
    return n, zlib.compress(np.packbits(~keep).tobytes(), 1) if n else None


def _rows(**columns) -> pa.RecordBatch:
    """A batch of ``_FOUND``; absent columns are null."""
    n = len(next(iter(columns.values())))
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    names = [c.split() for c in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], types[t]) if c in columns else pa.nulls(n, types[t]) for c, t in names], [c for c, _ in names])


class _Known:
    """Sorted hashes of a block with their totals."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]]):
        h0, h1, n, lead = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, t) for t in (np.int64, np.int32, np.int64, bool))
        order = np.argsort(h0, kind="stable")
        self.h0, self.h1, self.n, self.lead = h0[order], h1[order], n[order], lead[order]

    def find(self, h0: np.ndarray, h1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(total, lead) of each hash; total 0: not repeated."""
        if not len(self.h0):
            return np.zeros(len(h0), np.int64), np.zeros(len(h0), bool)
        at = np.minimum(np.searchsorted(self.h0, h0), len(self.h0) - 1)
        hit = (self.h0[at] == h0) & (self.h1[at] == h1)
        return np.where(hit, self.n[at], 0), hit & self.lead[at]


def _judge(window: int):
    """Of sorted (block, verdicts first, documents): kind 0 a document that is settled; 1 one with open windows; 2 an open or published window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, known = None, 0, None
        marks: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])).tolist() + [len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if blocks[a] != block:
                    block, number, known, marks = blocks[a], 0, None, []
                part = batch.slice(a, b - a)
                m = int((part.column("is_doc").to_numpy() == 0).sum())
                if m:
                    marks.append(tuple(part.column(c).slice(0, m).to_numpy(zero_copy_only=False) for c in ("h0", "h1", "n", "lead")))
                if m == b - a:
                    continue
                if known is None:
                    known, marks = _Known(marks), []
                docs = part.slice(m)
                yield from _documents(docs, known, int(block), number, window)
                number += docs.num_rows

    return run


def _documents(docs: pa.RecordBatch, known: _Known, block: int, number: int, window: int) -> Iterator[pa.RecordBatch]:
    texts = docs.column("text").cast(pa.large_binary()).to_pylist()
    ids = docs.column("doc_id").cast(pa.int64()).to_pylist()
    for row, n, p in _pieces(docs.column("text"), window):
        symbols = len(p.parse.names)
        spans, leads = np.zeros(symbols, np.int64), np.zeros(symbols, bool)
        spans[p.spans], leads[p.spans] = known.find(*p.span_hashes())
        revealed, _ = known.find(p.label_hashes(), np.zeros(symbols, np.int32))
        symbol_of = np.repeat(np.arange(symbols), np.diff(p.parse.starts))[p.first]
        found = spans[symbol_of] > 0
        # a window without a sure symbol may be anywhere
        held = np.where(p.symbol < 0, np.iinfo(np.int64).max, revealed[p.symbol] if symbols else 0)
        open_ = ~found & (held > 0)
        # others may hold the window of a verified span too: its label is found more often, and one of its holders tells them
        told = found & leads[symbol_of] & (held > spans[symbol_of])
        doc_of, base, size = p.parse.rows[symbol_of], p.bounds[:-1], np.diff(p.bounds)
        name = (np.int64(block) << np.int64(32)) + number + row
        for chosen, own, count in ((open_, True, 1), (told, False, 2)):
            if chosen.any():
                at = p.first[chosen]
                h0, h1 = _narrow(p.hash(at, at + window))
                yield _rows(kind=np.full(len(at), 2, np.int32), pid=name + doc_of[chosen] if own else np.full(len(at), -1), n=np.full(len(at), count),
                            start=(at - base[doc_of[chosen]]).astype(np.int32), h0=h0, h1=h1)
        pending = np.zeros(n, bool)
        pending[doc_of[open_]] = True
        f_doc, f_start = doc_of[found], p.first[found] - base[doc_of[found]]
        at = np.searchsorted(f_doc, np.arange(n + 1))
        out: dict[str, list] = {c: [] for c in ("kind", "pid", "doc_id", "text", "n_words", "n_removed", "repeated", "kept_sha256")}
        for i in range(n):
            starts, text = f_start[at[i]:at[i + 1]], texts[row + i] or b""
            if pending[i]:
                bits = np.zeros(size[i], bool)
                bits[starts] = True
                values = (1, int(name) + i, ids[row + i], zlib.compress(text, 1), int(size[i]), None, zlib.compress(np.packbits(bits).tobytes(), 1), None)
            else:
                keep = _keep(size[i], starts, window) if len(starts) else None
                gone, bits = (0, None) if keep is None else _removed(keep)
                values = (0, None, ids[row + i], None, int(size[i]), gone, bits, kept_sha256(text, keep))
            for c, v in zip(out, values):
                out[c].append(v)
        yield _rows(**out)


def _finish(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, removed, sha = [], [], []
            for text, n, bits, more in zip(*(batch.column(c).to_pylist() for c in ("text", "n_words", "repeated", "starts"))):
                first = np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8))[:n])
                keep = _keep(n, np.concatenate([first, np.array(more or [], np.int64)]), window)
                for out, v in zip((gone, removed), _removed(keep)):
                    out.append(v)
                sha.append(kept_sha256(zlib.decompress(text), keep))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(gone, pa.int64()), pa.array(removed, pa.binary()),
                                              pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "removed", "kept_sha256"])

    return run


def repeated_words(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (compressed bitmap over its words, null: none), kept_sha256.

    Removes each word covered by a window of ``window`` words whose words also
    start anywhere else.  Null and empty texts have no words, texts shorter
    than a window lose none.  Repeated rows are documents of their own, so
    their windows repeat; rows without a doc_id take part like all others.
    Rows with one id and one text share a block, which is read as a stream.
    Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, blocks // 8)
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    marks = materialize(docs.where("text is not null").select("text", "block").mapInArrow(_marks(window), "h0 long, h1 int, n long, block long"), "marks")
    known = repeated(marks, ["block"], parts)
    verdict = ["h0", "h1", "n", "lead"]
    no_doc = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text")]
    no_mark = [F.lit(None).cast(t).alias(c) for c, t in zip(verdict, ("long", "int", "long", "boolean"))]
    both = (known.select("block", F.lit(0).alias("is_doc"), *verdict, *no_doc)
            .unionByName(docs.select("block", F.lit(1).alias("is_doc"), *no_mark, "doc_id", "text")))
    found = materialize(both.repartition(parts, "block").sortWithinPartitions("block", "is_doc").mapInArrow(_judge(window), _FOUND), "judged")
    windows = found.where("kind = 2").select("h0", "h1", "n", "pid", "start")
    more = repeated(windows, ["pid", "start"], least).where("pid >= 0").groupBy("pid").agg(F.collect_list("start").alias("starts"))
    late = (found.where("kind = 1").select("pid", "doc_id", "text", "n_words", "repeated").join(more, "pid", "left")
            .mapInArrow(_finish(window), "doc_id long, n_words long, n_removed long, removed binary, kept_sha256 string"))
    # each task of these stages has one Python worker: the numbers come with the verdicts, not from a pass over the result
    return found.where("kind = 0").select("doc_id", "n_words", "n_removed", F.col("repeated").alias("removed"), "kept_sha256").unionByName(late)
