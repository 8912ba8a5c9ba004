"""Vectorised word and shingle hashing for Arrow string columns (numpy, inside tasks).

A word is a maximal run of characters other than the six ASCII white-space
characters ``\\x20`` and ``\\x09-\\x0D``.  Words are hashed as a sum of byte
values times powers of an odd constant (mod 2**64), then mixed, so one numpy
pass handles all the words of many texts; the constants come from a seeded
rule, so every task and every run hashes alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITESPACE = b" \t\n\x0b\x0c\r"
SHINGLE_WORDS = 5
CHUNK_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = (int(x) | 1 for x in _rng.integers(2**62, 2**63, 2, dtype=np.uint64))
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(WHITESPACE)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        factors = np.full(max(n, 4096), _BASE, np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over all 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, row offsets) over runs of whole rows of about ``chunk_bytes``.

    Null rows count as empty.  A single longer row makes a longer chunk.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1
        last = min(max(last, row + 1), n)
        yield row, data[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row]
        row = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, first word of each row plus the total) for one chunk."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = _IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    first[row_starts] = inside[row_starts]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    data = _LOWER[data] if lower else data
    data, inside = data[starts[0]:], inside[starts[0]:]
    place = np.arange(len(data))
    place -= np.repeat(starts - starts[0], np.diff(np.append(starts - starts[0], len(data))))
    value = _BYTE_VALUE[data]
    value *= _power_table(int(place.max()) + 1)[place]
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts - starts[0])), bounds


def shingle_sets(words: np.ndarray, bounds: np.ndarray, k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each row; shorter rows: the whole sequence as one."""
    step = np.cumprod(np.array([1] + [_STEP] * (k - 1), np.uint64), dtype=np.uint64)
    out = []
    if len(words) >= k:
        grams = words[:len(words) - k + 1].copy()
        for j in range(1, k):
            grams += words[j:len(words) - k + 1 + j] * step[j]
        grams = mix(grams)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            short = (words[a:b] * step[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
