"""Secret scan: fixed patterns plus character Markov models of random strings and ordinary identifiers.

Two order-1 models over a 70-symbol alphabet are trained from labelled
samples: *random* from the values that the fixed patterns find in all
documents and from ``SAMPLES`` seeded strings of each common key alphabet,
*ordinary* from every other run of identifier characters in all documents.
A run of at least ``MIN_RUN`` characters is a secret if its log-likelihood
ratio is high enough in all and per character.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The patterns and the least lengths of the kinds, in the order of the report
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "markov")

_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("passw", "secret", "token", "api")
_PASSWORD = ("password", "passwd")

MIN_RUN = 20
MIN_RATIO = 20.0
MIN_RATIO_PER_CHAR = 0.8
SAMPLES = 2000
BACK_OFF = 50.0
SEED = 20240229

SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
_N = len(SYMBOLS) + 1
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(1, _N)

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind number, end) of the fixed patterns, by start, then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(out)


def _values(text: str, spans: list[Span]) -> list[str]:
    return [ASSIGN.match(text, s)[2] if kind == 0 else text[s:e] for s, kind, e in spans]


def _bigrams(data: bytes) -> np.ndarray:
    code = _CODE[np.frombuffer(data, np.uint8)]
    return np.bincount(code[:-1] * _N + code[1:], minlength=_N * _N)


def _train_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ordinary, random = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
    for batch in batches:
        values = []
        texts = batch.column("text").to_pylist()
        for text in texts:
            values += _values(text, base_spans(text))
        # a separator on both sides of every text and value
        found = ("\n" + "\n".join(values) + "\n").encode()
        if values:
            counts = _bigrams(found)
            random += counts
            ordinary -= counts
        for i in range(0, len(texts), 500):
            ordinary += _bigrams(("\n" + "\n".join(texts[i:i + 500]) + "\n").encode())
    for label, counts in ((0, ordinary), (1, random)):
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), label, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["label", "pair", "n"])


def sample_strings(samples: int = SAMPLES, seed: int = SEED) -> list[str]:
    """Seeded random strings of 40 characters over hex, base-32, base-62 and base-64 alphabets."""
    rng = np.random.Generator(np.random.PCG64(seed))
    alphabets = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", SYMBOLS[:62], SYMBOLS[:62] + "+/", SYMBOLS[:62] + "_-")
    return ["".join(a[i] for i in rng.integers(0, len(a), 40)) for a in alphabets for _ in range(samples)]


def train_ratio(docs: DataFrame) -> np.ndarray:
    """(N, N) log-likelihood ratios random : ordinary of the character pairs, from all documents.

    Row and column 0 stand for every character outside the alphabet.
    """
    rows = (docs.select("text").where("text is not null").mapInArrow(_train_counts, "label int, pair int, n long")
            .groupBy("label", "pair").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros((2, _N * _N))
    for r in rows:
        counts[r.label, r.pair] = max(0, r.n)
    counts[1] += _bigrams(("\n" + "\n".join(sample_strings()) + "\n").encode())
    logs = [np.log(transition_shares(c)) for c in counts.reshape(2, _N, _N)]
    ratio = np.zeros((_N, _N))
    ratio[:, 1:] = logs[1] - logs[0]
    return ratio


def transition_shares(counts: np.ndarray) -> np.ndarray:
    """(N, N - 1) probabilities of the next symbol; rare contexts lean on the symbol frequencies by ``BACK_OFF`` counts."""
    pairs = counts[:, 1:]
    symbols = pairs.sum(axis=0) + 0.5
    return (pairs + BACK_OFF * symbols / symbols.sum()) / (pairs.sum(axis=1, keepdims=True) + BACK_OFF)


def run_ratio(run: str, ratio: np.ndarray) -> float:
    code = _CODE[np.frombuffer(b"\n" + run.encode(), np.uint8)]
    return float(ratio[code[:-1], code[1:]].sum())


def markov_spans(text: str, taken: list[Span], ratio: np.ndarray) -> list[Span]:
    """Runs of identifier characters that look random and touch no span of the fixed patterns (``taken``, by start)."""
    starts = [a for a, _, _ in taken]
    reach = list(accumulate((b for _, _, b in taken), max))  # how far the spans up to this one go
    out = []
    for m in _RUN.finditer(text):
        s, e = m.span()
        before = bisect_left(starts, e)
        if before and reach[before - 1] > s:
            continue
        score = run_ratio(m[0], ratio)
        if score >= MIN_RATIO and score >= MIN_RATIO_PER_CHAR * (e - s):
            out.append((s, 3, e))
    return out


def span_list(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{s}:{e}" for s, kind, e in sorted(spans))


def _scan(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                for kind in range(3):
                    counts[kind].append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(span_list(base).encode()).hexdigest())
                spans.append(span_list(base + markov_spans(text, base, ratio)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points.  A null text counts as empty; ids
    are passed through (null too), repeated rows are scanned each, and an
    empty table gives no rows.
    """
    ratio = train_ratio(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(ratio), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
