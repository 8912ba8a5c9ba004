"""Word hashing, sketches and the flow solver: no Spark needed."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from clickpath.llm.flow import min_cost_transport
from clickpath.llm.hashing import shingle_sets, utf8_chunks, word_hashes
from clickpath.llm.mixture import subset_sum
from clickpath.llm.sketch import band_keys, sketch_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(w):
    return re.sub("[A-Z]", lambda m: m[0].lower(), w)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_word_hashes_agree_with_words(chunk):
    texts = ["", None, " a  b\tA\n", "x", "\x0bé É\x0c", "a b c d e f a b c d e", "word" * 50, "  ", "tail"]
    by_hash, total = {}, 0
    for row, data, offsets in utf8_chunks(pa.array(texts), chunk):
        h, bounds = word_hashes(data, offsets)
        for i, (a, b) in enumerate(itertools.pairwise(bounds.tolist())):
            expected = [_lower(w) for w in WORD.findall(texts[row + i] or "")]
            assert len(expected) == b - a
            for w, x in zip(expected, h[a:b].tolist()):
                assert by_hash.setdefault(w, x) == x
                total += 1
    assert len(set(by_hash.values())) == len(by_hash)
    assert total == sum(len(WORD.findall(t or "")) for t in texts)


def test_shingle_sets_count_distinct_shingles():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 4, 5, 6, 40, 400)]
    sets = []
    for _, data, offsets in utf8_chunks(pa.array(texts)):
        sets += shingle_sets(*word_hashes(data, offsets))
    for text, found in zip(texts, sets):
        w = text.split()
        grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        assert len(found) == len(grams)


def test_sketch_estimates_jaccard_and_fills_every_coordinate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    for size in (1, 3, 50, 1000):
        a = np.unique(pool[:size])
        for share in (0.0, 0.5, 0.9, 1.0):
            keep = int(size * share)
            b = np.unique(np.concatenate([pool[:keep], pool[2000:2000 + size - keep]]))
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = sketch_sets([a, b], 1024)
            assert (s != 2**64 - 1).all()
            assert abs((s[0] == s[1]).mean() - j) < 0.09
    empty = sketch_sets([np.zeros(0, np.uint64), a], 64)
    assert not empty[0].any()
    keys = band_keys(sketch_sets([a, a], 96), 4)
    assert keys.shape == (2, 24) and (keys[0] == keys[1]).all() and len(set(keys[0].tolist())) == 24


def test_min_cost_transport_against_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        supply = [rng.randint(0, 4) for _ in range(2)]
        capacity = [rng.randint(0, 4) for _ in range(3)]
        if sum(capacity) < sum(supply):
            with pytest.raises(ValueError):
                min_cost_transport(supply, capacity, [[0] * 3] * 2)
            continue
        cost = [[rng.randint(0, 5) for _ in range(3)] for _ in range(2)]
        flow = min_cost_transport(supply, capacity, cost)
        assert [sum(r) for r in flow] == supply
        assert all(sum(r[j] for r in flow) <= capacity[j] for j in range(3))
        splits = [[s for s in itertools.product(range(n + 1), repeat=3) if sum(s) == n] for n in supply]
        best = min(sum(c * x for row, got in zip(cost, pick) for c, x in zip(row, got))
                   for pick in itertools.product(*splits) if all(sum(p[j] for p in pick) <= capacity[j] for j in range(3)))
        assert sum(c * x for row, got in zip(cost, flow) for c, x in zip(row, got)) == best


def test_subset_sum_against_brute_force():
    rng = random.Random(7)
    for _ in range(200):
        lengths = rng.sample(range(1, 12), rng.randint(1, 4))
        counts = [rng.randint(0, 3) for _ in lengths]
        budget = rng.randint(0, 30)
        take = subset_sum(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        sums = {sum(n * k for n, k in zip(lengths, pick)) for pick in itertools.product(*[range(c + 1) for c in counts])}
        best = min((s for s in sums), key=lambda s: (abs(s - budget), s))
        assert sum(n * t for n, t in zip(lengths, take)) == best


def test_packed_numbers_round_trip():
    from clickpath.llm.hmm import pack_numbers, unpack_numbers
    for numbers in ([], [0], [1, 255, 256, 70_000, 2**32 - 1]):
        assert unpack_numbers(pack_numbers(np.array(numbers, np.int64))).tolist() == numbers
