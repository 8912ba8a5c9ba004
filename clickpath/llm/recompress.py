"""Local recompression of word sequences (numpy, inside tasks).

A round names runs, then pairs, over the symbols that the round before left:

* run: of a run of four or more equal symbols, all but the first and the last
  become one symbol named by (symbol, count);
* pair: every symbol has a side, a bit of its name and the round; a left
  symbol directly before a right one becomes one symbol named by both, if it
  spans at most ``MAX_WORDS`` words.

A name is a hash of what it stands for, so all tasks give equal substrings
equal names without asking each other.  What happens to a symbol depends on
its two neighbours alone: inside two equal word windows all symbols agree, but
for a few at either end.  :func:`cores` gives the symbols of a window that
every equal window must share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from clickpath.llm.hashing import mix

ROUNDS = 6
MAX_WORDS = 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_RUN = np.uint64(0xD1B54A32D192ED03)
_BASES = (0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407 | 1)


@dataclass
class Parse:
    """Symbols of one chunk after the last round, and how each round maps symbols that open or close a window."""

    names: np.ndarray  # name of every symbol
    starts: np.ndarray  # first word of every symbol, and the number of words
    rows: np.ndarray  # row of every symbol
    opens: list[np.ndarray]  # per round: first sure symbol of a window that opens at this symbol
    closes: list[np.ndarray]  # per round: end of the sure symbols of a window that closes before this symbol


def _name_runs(names, starts, rows):
    """(names, starts, rows, map of symbol indices) with the inner part of every run named; the map gives the symbol an index falls in."""
    n = len(names)
    first = np.ones(n, bool)
    first[1:] = (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(first)
    length = np.diff(np.append(at, n))
    long = length >= 4
    if not long.any():
        return names, starts, rows, None, first
    keep = np.ones(n, bool)
    gone = np.zeros(n + 1, np.int64)
    np.add.at(gone, at[long] + 2, 1)
    np.add.at(gone, at[long] + length[long] - 1, -1)
    keep[np.cumsum(gone[:-1]) > 0] = False
    named = names.copy()
    named[at[long] + 1] = mix(names[at[long]] * _RUN + (length[long] - 2).astype(np.uint64))
    index = np.cumsum(keep) - 1
    return named[keep], np.append(starts[:-1][keep], starts[-1]), rows[keep], index, first


def parse(words: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS, max_words: int = MAX_WORDS) -> Parse:
    """Recompress the rows of a chunk; ``bounds``: first word of each row plus the total."""
    names = words
    starts = np.arange(len(words) + 1)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    opens, closes = [], []
    for r in range(rounds):
        n = len(names)
        if not n:
            break
        names, starts, rows, index, first = _name_runs(names, starts, rows)
        # run: of the copies at an open end only the last one (first one) is sure
        ends = np.append(np.flatnonzero(first)[1:], n) - 1
        run = np.cumsum(first) - 1
        open_at = ends[run]
        close_at = np.append(0, np.flatnonzero(first)[run] + 1)
        if index is not None:
            open_at = index[open_at]
            close_at = np.append(0, index[close_at[1:] - 1] + 1)
        # pair
        n = len(names)
        size = np.diff(starts)
        right = (mix(names + np.uint64(r * int(_ODD) % 2**64)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(n + 1, bool)  # joins[i]: symbol i goes to the one before it
        joins[1:n] = ~right[:-1] & right[1:] & (rows[1:] == rows[:-1]) & (size[1:] + size[:-1] <= max_words)
        keep = ~joins[:-1]
        index = np.append(np.cumsum(keep) - 1, keep.sum())
        small = size < max_words
        sure_open = np.arange(n) + (right & small)
        sure_close = np.arange(n + 1)
        sure_close[1:] -= ~right & small
        opens.append(index[sure_open][open_at])
        # a sure end falls between symbols: the number of new symbols that start before it
        closes.append(np.append(index[:-1], index[-1])[sure_close][close_at])
        named = names.copy()
        heads = np.flatnonzero(joins[1:])
        named[heads] = mix((names[heads] * _ODD) ^ mix(names[np.minimum(heads + 1, n - 1)] + np.uint64(r)))
        names, rows = named[keep], rows[keep]
        starts = np.append(starts[:-1][keep], starts[-1])
    return Parse(names, starts, rows, opens, closes)


def cores(p: Parse, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) symbol of the sure part of the ``size``-word windows that start at the words ``first`` (end <= first: none)."""
    a, b = first, first + size
    for opened, closed in zip(p.opens, p.closes):
        a = opened[np.minimum(a, len(opened) - 1)]
        b = closed[np.minimum(b, len(closed) - 1)]
    return a, b


def longest_symbols(p: Parse, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of the symbol that spans most words in each range a <= i < b (ties: the largest name, then the first); -1 for an empty range.

    Range maxima come from a table of the maxima of all ranges of 2**k symbols.
    """
    out = np.full(len(a), -1, np.int64)
    some = b > a
    if not some.any():
        return out
    a, b = a[some], b[some]
    rank = labels(p)
    n = len(rank)
    level = np.log2(b - a).astype(np.int64)  # exact: ranges are short
    best = np.arange(n)
    found = np.zeros(len(a), np.int64)
    for k in range(int(level.max()) + 1):
        mine = level == k
        x, y = best[a[mine]], best[b[mine] - (1 << k)]
        found[mine] = np.where(rank[y] > rank[x], y, x)
        if k < level.max():
            half = 1 << k
            left, right = best[:n - 2 * half + 1], best[half:n - half + 1]
            best = np.where(rank[right] > rank[left], right, left)
    out[some] = found
    return out


def labels(p: Parse) -> np.ndarray:
    """A label of every symbol: the words that it spans (63 and more alike) above the top bits of its name."""
    return (np.minimum(np.diff(p.starts), 63).astype(np.uint64) << np.uint64(58)) | (p.names >> np.uint64(6))


class SpanHash:
    """128-bit hashes of word spans of one chunk, by prefix sums of two polynomials."""

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        self._sums, self._inverse = [], []
        for i, base in enumerate(_BASES):
            value = mix(words ^ (np.uint64(i * int(_ODD) % 2**64)))
            up = np.full(n, base, np.uint64)
            up[0] = 1
            down = np.full(n, pow(base, -1, 2**64), np.uint64)
            down[0] = 1
            sums = np.zeros(n, np.uint64)
            np.cumsum(value * np.cumprod(up, dtype=np.uint64)[:-1], dtype=np.uint64, out=sums[1:])
            self._sums.append(sums)
            self._inverse.append(np.cumprod(down, dtype=np.uint64))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = (b - a).astype(np.uint64)
        return tuple(mix((s[b] - s[a]) * inv[a] + size).view(np.int64) for s, inv in zip(self._sums, self._inverse))
