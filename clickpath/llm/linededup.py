"""Line de-duplication over range-partitioned line hashes.

Long lines become rows (128-bit key hash, doc_id, position), range-partitioned
and sorted by all of them, so a line that a third of the documents share is
spread over many ranges.  One pass streams each range: runs of equal hashes
that lie inside the range are decided there; the first and the last run of a
range may go on in its neighbours, so they leave a partial count and their
rows, and the (at most two) open hashes of each range are settled together.
The answer is one compressed bitmap per document (1: keep the line), never text.
A text is named by its doc_id and a hash of it, so different texts under one
doc_id lose their own lines.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickpath.llm.storage import materialize

MIN_CODE_POINTS = 40
MIN_DOCUMENTS = 5
SPACE = " \t\n\x0b\x0c\r"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO_LOWER = str.maketrans(_UPPER, _UPPER.lower())

# kind: 0 a dropped line, 1 a partial count of an open run, 2 a line of an open run
_DECISION = "kind int, h0 long, h1 long, doc_id long, text_hash long, pos int, docs long"
_LINE = "h0 long, h1 long, doc_id long, text_hash long, pos int"
_TEXT = ["doc_id", "text_hash"]


def line_key(line: str) -> str:
    return line.strip(SPACE).translate(_TO_LOWER)


def _line_rows(min_code_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h0, h1, of, at = [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for i, line in enumerate(text.split("\n")):
                    if len(line) >= min_code_points and len(key := line_key(line)) >= min_code_points:
                        h = xxhash.xxh3_128_intdigest(key.encode())
                        h0.append(h >> 64)
                        h1.append(h & (2**64 - 1))
                        of.append(row)
                        at.append(i)
            rows = pa.array(of, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(h0, np.uint64).view(np.int64)), pa.array(np.array(h1, np.uint64).view(np.int64)),
                batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(at, pa.int32())],
                ["h0", "h1", "doc_id", "text_hash", "pos"])

    return run


def _decide(min_documents: int):
    def rows(kind, h0, h1, doc, text, pos, docs):
        n = len(h0)
        full = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), n).astype(t))
        return pa.RecordBatch.from_arrays(
            [full(kind, np.int32), full(h0, np.int64), full(h1, np.int64), full(doc, np.int64), full(text, np.int64),
             full(pos, np.int32), full(docs, np.int64)], ["kind", "h0", "h1", "doc_id", "text_hash", "pos", "docs"])

    def settle(h0, h1, doc, text, pos, first_open: bool, last_open: bool):
        """Decide whole runs of one sorted piece; open runs are passed on."""
        change = np.ones(len(h0), bool)
        change[1:] = (h0[1:] != h0[:-1]) | (h1[1:] != h1[:-1])
        new_doc = change.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        run = np.cumsum(change) - 1
        docs = np.bincount(run, new_doc).astype(np.int64)
        starts = np.flatnonzero(change)
        largest = doc[np.append(starts[1:], len(doc)) - 1]
        is_open = np.zeros(len(starts), bool)
        is_open[0] |= first_open
        is_open[-1] |= last_open
        drop = (docs >= min_documents) & ~is_open
        gone = drop[run] & (doc != largest[run])
        if gone.any():
            yield rows(0, h0[gone], h1[gone], doc[gone], text[gone], pos[gone], 0)
        if is_open.any():
            yield rows(1, h0[starts[is_open]], h1[starts[is_open]], largest[is_open], 0, 0, docs[is_open])
            mine = is_open[run]
            yield rows(2, h0[mine], h1[mine], doc[mine], text[mine], pos[mine], 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            piece = [batch.column(c).to_numpy() for c in ("h0", "h1", "doc_id", "text_hash", "pos")]
            other = np.flatnonzero((piece[0] != piece[0][-1]) | (piece[1] != piece[1][-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if not cut and held and (held[0][0][0] != piece[0][0] or held[0][1][0] != piece[1][0]):
                yield from settle(*map(np.concatenate, zip(*held)), first, False)
                held, first = [], False
            if cut:
                held.append([c[:cut] for c in piece])
                yield from settle(*map(np.concatenate, zip(*held)), first, False)
                held, first = [], False
            held.append([c[cut:] for c in piece])
        if held:
            yield from settle(*map(np.concatenate, zip(*held)), first, True)

    return run


def text_hash() -> Column:
    return F.xxhash64("text").alias("text_hash")


def dropped_lines(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS,
                  min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_hash, pos): every line that goes, by the position from 0 in its text."""
    spark = docs.sparkSession
    lines = materialize(
        docs.select("doc_id", "text", text_hash()).where("doc_id is not null and text is not null")
        .mapInArrow(_line_rows(min_code_points), _LINE), "lines")
    order = ["h0", "h1", *_TEXT, "pos"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges end between documents of a line, so partial counts of documents add up
    decided = materialize(
        lines.repartitionByRange(parts, "h0", "h1", "doc_id").sortWithinPartitions(*order)
        .mapInArrow(_decide(min_documents), _DECISION), "line-decisions")
    # at most two open hashes a range: its size depends on the number of ranges alone
    settled = (decided.where("kind = 1").groupBy("h0", "h1")
               .agg(F.sum("docs").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_documents))
    late = (decided.where("kind = 2").select("h0", "h1", *_TEXT, "pos").join(F.broadcast(settled), ["h0", "h1"])
            .where("doc_id <> last").select(*_TEXT, "pos"))
    return decided.where("kind = 0").select(*_TEXT, "pos").unionByName(late)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for at in batch.column("drops").to_pylist():
            keep = np.ones(-(-(max(at) + 1) // 8) * 8, bool)  # whole bytes: the last one's spare bits keep
            keep[at] = False
            out.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(d) for d in batch.column("drops")], pa.int64()),
             pa.array(out, pa.binary())], [*_TEXT, "n_dropped", "keep_bitmap"])


def keep_bitmaps(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS,
                 min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep_bitmap) of the texts that lose a line.

    The bitmap holds a bit for each line up to the last dropped one and the end
    of its byte (1: keep; later lines stay), packed by ``numpy.packbits`` and compressed by zlib.
    """
    return (dropped_lines(docs, min_code_points, min_documents).distinct()
            .groupBy(*_TEXT).agg(F.collect_list("pos").alias("drops"))
            .mapInArrow(_bitmaps, "doc_id long, text_hash long, n_dropped long, keep_bitmap binary"))


def kept_text(text: str, bitmap: bytes | None) -> str:
    """The lines that the bitmap keeps, joined by a line feed."""
    if bitmap is None:
        return text
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i >= len(keep) or keep[i])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, sha = [], []
        for text, bitmap in zip(batch.column("text").to_pylist(), batch.column("keep_bitmap").to_pylist()):
            text = text or ""
            n.append(text.count("\n") + 1)
            sha.append(hashlib.sha256(kept_text(text, bitmap).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), batch.column("n_dropped"), pa.array(sha)],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text, n_dropped (0 if untouched) and keep_bitmap (null if untouched) of every document."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash()).join(bitmaps.hint("shuffle_hash"), _TEXT, "left")
            .select("doc_id", "text", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep_bitmap"))


def line_digests(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS,
                 min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256.

    A null or empty text is one empty line.  Rows without a doc_id lose
    nothing and count for nothing.  Repeated rows are one document to the
    count, and each of them loses the same lines; different texts under one
    doc_id are one document to the count, and each loses its own lines.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return apply_bitmaps(docs, keep_bitmaps(docs, min_code_points, min_documents)).mapInArrow(
        _digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
