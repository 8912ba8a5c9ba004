"""Fast similarity sketching: hashed bin placement in rounds until every coordinate is full.

Round ``i < t`` throws every element into one of ``t`` bins by a hash of its
own; rounds ``t .. 2t-1`` throw all elements into bin ``i - t``.  A bin keeps
the smallest (round, value) it has seen, so bins filled by an earlier round
stay, a set stops as soon as its bins are full, and no coordinate can remain
empty.  Two sets agree on a coordinate with probability equal to their
Jaccard similarity, and the number of equal coordinates is concentrated as
for independent draws without replacement.
"""

from __future__ import annotations

import numpy as np

from clickpath.llm.hashing import mix

_STEP = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1


def sketch_sets(sets: list[np.ndarray], t: int) -> np.ndarray:
    """(len(sets), t) uint64 coordinates; rows of empty sets are all zero and mean nothing."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    empty = np.uint64(2**64 - 1)
    bins = np.full((n, t), empty, np.uint64)
    flat = bins.reshape(-1)
    elements = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    for i in range(2 * t):
        if not len(elements):
            break
        drawn = mix(elements + np.uint64(_STEP * (i + 1) & _MASK))
        if i < t:
            place = owner * t + (drawn % np.uint64(t)).astype(np.int64)
        else:
            place = owner * t + (i - t)
        # the value doubles as the identity of (round, element): a bijection of
        # the element under the round's constant
        value = mix(drawn) >> np.uint64(1)
        if i:
            open_bin = ~filled[place]
            place, value = place[open_bin], value[open_bin]
        np.minimum.at(flat, place, value)
        filled = flat != empty
        full = filled.reshape(n, t).all(axis=1)
        if i == 0 or full[owner].any():
            keep = ~full[owner]
            elements, owner = elements[keep], owner[keep]
    bins[sizes == 0] = 0
    return bins


def band_keys(bins: np.ndarray, rows: int) -> np.ndarray:
    """(n, t // rows) int64 keys: one hash of each run of ``rows`` coordinates, with the band's number."""
    n, t = bins.shape
    bands = t // rows
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (n, 1))
    for j in range(rows):
        key = mix(key * np.uint64(_STEP) + bins[:, j:bands * rows:rows])
    return key.view(np.int64)
