"""Recompression, conversation trie and ranked search against brute force: nulls, runs, ties, repeated rows, empty and odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from clickpath.llm import ranking, recompress, substrings, trie
from clickpath.llm.hashing import utf8_chunks, word_hashes

from test_operators import WORD, awkward, docs_df, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TURNS = "conv_id long, turn long, role string, text string, key string, block long, part int, depth long, at int, h int, name string"


# --- recompression ---------------------------------------------------------------------------------------------

def brute_windows(rows, size):
    """Counter of (doc_id, n_words, n_removed, kept_sha256)."""
    texts = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    seen = collections.Counter(tuple(w[i:i + size]) for _, w in texts for i in range(len(w) - size + 1))
    out = collections.Counter()
    for doc, w in texts:
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out[doc, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()] += 1
    return out


def removed(df, **kw):
    return collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeated_words(df, **kw).collect())


def passages(seed, size):
    """Texts that share passages around the window length, copies, runs, periods and overlapping repeats."""
    rng = random.Random(seed)
    base = [prose(rng, 300).split() for _ in range(3)]
    rows = []
    for i in range(60):
        words = prose(rng, rng.randint(0, 80)).split()
        for _ in range(rng.randint(0, 3)):
            b = rng.choice(base)
            a = rng.randrange(len(b))
            words += b[a:a + rng.choice([size - 1, size, size + 1, size + 7, 3 * size])] + prose(rng, rng.randint(0, 5)).split()
        rows.append((i, " ".join(words)))
    rows += [(100, "the " * 400), (101, "a b " * (size // 2)), (102, "a b " * size + "c"), (103, "x y z " * 300), (104, "q " + "the " * size),
             (105, "the " * (size - 1)), (106, " ".join(base[0])), (107, " ".join(base[0])), (108, "\n".join(base[0][:150]) + "\tend")]
    return rows


@pytest.mark.parametrize("size", [35, 12])
def test_windows_against_brute_force(spark, size):
    rows = passages(3, size) + awkward(7)
    assert removed(docs_df(spark, rows), window=size, block_bytes=4000) == brute_windows(rows, size)


def test_a_rim_window_meets_a_verified_one(spark):
    rng = random.Random(5)
    long, other = prose(rng, 400, [f"u{i}" for i in range(5000)]).split(), prose(rng, 300, [f"v{i}" for i in range(5000)]).split()
    rows = [(1, " ".join(long)), (2, " ".join(long))]
    rows += [(10 + i, " ".join(other[i * 5:i * 5 + 9] + long[50 + 7 * i:50 + 7 * i + 35] + other[i * 5 + 9:i * 5 + 12])) for i in range(30)]
    assert removed(docs_df(spark, rows), block_bytes=2000) == brute_windows(rows, 35)


def test_windows_of_empty_and_repeated_rows(spark):
    rng = random.Random(6)
    text = prose(rng, 60)
    assert removed(docs_df(spark, [])) == collections.Counter()
    rows = [(None, text), (None, text), (4, text), (4, prose(rng, 70)), (4, None), (None, "")]
    assert removed(docs_df(spark, rows)) == brute_windows(rows, 35)


def test_equal_windows_share_their_sure_symbols():
    rng = random.Random(11)
    core = [rng.choice("abcdefgh") for _ in range(60)]
    texts = [" ".join([rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))] + core + [rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))])
             for _ in range(20)]
    import pyarrow as pa
    seen = collections.defaultdict(set)
    for _, data, offsets in utf8_chunks(pa.array(texts)):
        words, bounds = word_hashes(data, offsets, lower=False)
        p = recompress.parse(words, bounds)
        assert p.starts[0] == 0 and p.starts[-1] == len(words) and (np.diff(p.starts) > 0).all()
        for a, b in zip(bounds[:-1], bounds[1:]):
            first = np.arange(a, b - 34)
            lo, hi = recompress.cores(p, first, 35)
            for f, x, y in zip(first, lo, hi):
                inner = tuple((int(p.starts[k] - f), int(p.names[k])) for k in range(x, y))
                assert all(p.starts[k] >= f and p.starts[k + 1] <= f + 35 for k in range(x, y))
                seen[tuple(words[f:f + 35])].add(inner)
    assert any(len(inner) for inners in seen.values() for inner in inners)
    assert all(len(inners) == 1 for inners in seen.values())


def test_long_symbols_by_range_maxima():
    rng = np.random.default_rng(2)
    names = rng.integers(1, 2**63, 300, dtype=np.uint64)
    starts = np.append(0, np.cumsum(rng.integers(1, 5, 300)))
    p = recompress.Parse(names, starts, np.zeros(300, int), [], [])
    rank = recompress.labels(p)
    a = rng.integers(0, 300, 500)
    b = np.minimum(a + rng.integers(0, 30, 500), 300)
    got = recompress.longest_symbols(p, a, b)
    for x, y, g in zip(a, b, got):
        assert g == (-1 if y <= x else x + int(np.argmax(rank[x:y])))


def test_kept_digest_in_segments(monkeypatch):
    monkeypatch.setattr(substrings, "_SEGMENT", 50)
    rng = random.Random(8)
    text = " \t".join(prose(rng, 400).split())
    words = text.split()
    keep = np.array([rng.random() < 0.5 for _ in words])
    for k in (None, keep, np.zeros(len(words), bool)):
        want = " ".join(w for i, w in enumerate(words) if k is None or k[i])
        assert substrings.kept_sha256(text.encode(), k) == hashlib.sha256(want.encode()).hexdigest()


# --- conversation trie -----------------------------------------------------------------------------------------

def brute_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not children[p]
    return sorted(
        (min(m), len(p), -1 if not p else min(members[p[:-1]]), len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def trie_rows(spark, rows, parts=8, block_rows=20_000):
    df = spark.createDataFrame([(*r, "k", 3, 1, 9, 2, 1, "n") for r in rows], TURNS).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = trie.conversation_trie(df, block_rows).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in got)


def talks(seed, n, words="ab"):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 700), n):
        for t in range(rng.randint(1, 7)):
            rows.append((c, rng.choice([t, t, t, None, 2]), rng.choice(["user", None, ""]), rng.choice([*words, None, "", "é" * 9])))
    return rows


@pytest.mark.parametrize("parts,block_rows", [(2, 20_000), (23, 1), (8, 5)])
def test_trie_against_brute_force(spark, parts, block_rows):
    rows = talks(parts, 120)
    rows += [(1000 + i, t, "user", x) for i in range(60) for t, x in enumerate("same talk".split())]  # one conversation, many times
    rows += [(5000, t, "user", "z" * (t % 3)) for t in range(300)] + [(5001, t, "user", "z" * (t % 3)) for t in range(250)]
    rows += rows[:10] + [(None, 0, "user", "lost")]
    assert trie_rows(spark, rows, parts, block_rows) == brute_trie(rows)


def test_trie_of_odd_tables(spark):
    assert trie_rows(spark, []) == [] and trie_rows(spark, [(None, 1, "user", "x")]) == []
    empty = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    only_root = [(empty, 0, "user", "x")]
    assert trie_rows(spark, only_root) == brute_trie(only_root) and len(brute_trie(only_root)) == 1
    long = [(1, 0, "user", "y" * 200_000), (2, 0, "user", "y" * 200_000), (7, None, None, None)]
    assert trie_rows(spark, long) == brute_trie(long)


def test_range_minimum_searches():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 5, 200)
    table = trie.RangeMinimum(values)
    i, d = rng.integers(0, 200, 400), rng.integers(0, 6, 400)
    last, first = table.last(i, d), table.first(i, d)
    for x, y, a, b in zip(i.tolist(), d.tolist(), last.tolist(), first.tolist()):
        j = x
        while j + 1 < 200 and values[j + 1] >= y:
            j += 1
        k = x
        while k >= 1 and values[k] >= y:
            k -= 1
        assert (a, b) == (j, k)
    lo = rng.integers(0, 100, 50)
    hi = lo + rng.integers(0, 100, 50)
    assert table.lowest(lo, hi).tolist() == [values[a:b + 1].min() for a, b in zip(lo, hi)]


# --- ranked search ---------------------------------------------------------------------------------------------

def brute_rank(docs, items, k):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    rows = [(d, collections.Counter(TERM.findall(low(t)))) for d, t, *_ in docs]
    rows = [(d, c, sum(c.values())) for d, c in rows if c]
    total, length = len(rows), sum(n for *_, n in rows)
    df = collections.Counter(t for _, c, _ in rows for t in c)
    terms = collections.defaultdict(set)
    for item, text in items:
        if item is not None:
            terms[item] |= set(TERM.findall(low(text)))
    out = []
    for item, ts in terms.items():
        scores = []
        for x, (d, c, n) in enumerate(rows):
            m = 50 + (50 * n * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, x))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=lambda r: r[:2])


def ranked(spark, docs, items, **kw):
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id long, score long")
    return sorted((tuple(r) for r in ranking.rank_documents(docs_df(spark, docs), b, **kw).collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("kw", [{"k": 50}, {"k": 3, "shard_docs": 20}, {"k": 5, "group_terms": 7}])
def test_ranking_against_brute_force(spark, kw):
    rng = random.Random(12)
    vocabulary = [f"t{i}" for i in range(60)] + ["Été", "ÉTÉ", "x9", "Q"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    draw = lambda n: rng.choice([" ", "-", "\x7f"]).join(rng.choices(vocabulary, weights, k=n))
    docs = awkward(3)[:9] + [(100 + i, draw(rng.randint(1, 60))) for i in range(200)] + [(300, "t50 t51"), (300, "t50 t51"), (None, "t50 t51"), (299, "t50 t51")]
    items = [(i, draw(rng.randint(1, 12))) for i in range(30)] + [(50, "t50 t51"), (50, "t52"), (None, "t1"), (51, None), (52, "..."), (53, "absent"), (1, "t0")]
    assert ranked(spark, docs, items, **kw) == brute_rank(docs, items, kw["k"])


def test_ranking_of_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == [] and ranked(spark, [(1, "a")], []) == [] and ranked(spark, [(1, None)], [(1, "a")]) == []


def test_terms_of_long_texts_are_counted_in_segments(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice(["abc", "DE", " ", "é", "!", "x" * 40]) for _ in range(3000)).encode()
    whole = ranking.count_terms(text)
    monkeypatch.setattr(ranking, "_SEGMENT", 64)
    assert ranking.count_terms(text) == whole


def test_accumulators_stop_when_the_rest_cannot_reach_the_kth_score():
    # a rare heavy term in documents 0-3, a light one everywhere
    start, doc = np.array([0, 4, 104]), np.concatenate([np.arange(4), np.arange(100)])
    gain = np.concatenate([np.full(4, 1000), np.arange(100)])
    (item, best, scores, made), = ranking.best_of_shard([[0, 1]], start, doc, gain, np.array([1000, 99]), [50, 1], 100, np.arange(100), 2)
    assert made == 4 and best.tolist() == [3, 2] and scores.tolist() == [1003, 1002]
    (_, best, scores, made), = ranking.best_of_shard([[0, 1]], start, doc, gain, np.array([1000, 99]), [50, 1], 100, np.arange(100), 5)
    assert made == 100 and best.tolist() == [3, 2, 1, 0, 99]
