"""The registered queries against DuckDB, and the pipeline against a brute-force version of each stage."""

import collections
import glob
import itertools
import math
import os
import random
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from clickpath.llm import mixture, quality
from clickpath.llm.queries import ORACLE_SQL, QUERIES

from conftest import SF_SMALL
from test_operators import WORD, brute_base, brute_components, brute_targets, docs_df, prose

HERE = SF_SMALL


def norm(v):
    return None if v is None else round(v, 6) + 0.0 if isinstance(v, float) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{HERE}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, HERE)
    result = duck.execute(ORACLE_SQL[key])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_every_operator_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]


def test_contract_columns(spark):
    first = {
        "op2_flow_reshard": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op3_budget_mix": ["doc_id", "size", "source_size", "target", "taken"],
        "op8_hmm_scores": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op10_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    }
    n = spark.read.parquet(f"{HERE}/documents.parquet").count()
    for key, columns in first.items():
        df = QUERIES[key](spark, HERE)
        assert df.columns[:len(columns)] == columns
        assert df.count() == n


# --- the pipeline ----------------------------------------------------------------------------------------------

def js(p, q):
    p, q = [v / sum(p) for v in p], [v / sum(q) for v in q]
    out = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        out += sum(x * math.log2(x / m) for x in (a, b) if x > 0) / 2
    return math.sqrt(max(out, 0.0))


def brute_quality(docs):
    """{doc_id: kept}."""
    def histograms(text, lang):
        n = [sum(c in chars for c in text) for chars in quality.CLASSES.values()]
        n.append(len(text.encode()) - len(text))
        n.append(len(text.encode()) - sum(n))
        vocabulary = quality.COMMON_WORDS[lang]
        w = collections.Counter(WORD.findall(text))
        common = [w[v] + (w[v.capitalize()] if v.capitalize() != v else 0) for v in vocabulary]
        return n, common + [sum(w.values()) - sum(common)]

    base = {d: brute_base(t) for d, t, *_ in docs}
    hist = {d: histograms(t, lang) for d, t, lang, _ in docs}
    words, refs = collections.Counter(), {}
    for d, t, lang, _ in docs:
        if not base[d][5]:
            words[lang] += base[d][0]
            for k in (0, 1):
                total = sum(hist[d][k])
                ref = refs.setdefault((lang, k), [0] * len(hist[d][k]))
                for i, v in enumerate(hist[d][k]):
                    ref[i] += math.floor(v * 1_000_000 / total)
    def distances(d, t, lang):
        n, common, ref = base[d][0], hist[d][1], refs.get((lang, 1))
        if words[lang] < quality.MIN_REFERENCE_WORDS:
            return {}
        out = {"char": js(hist[d][0], refs[lang, 0])} if len(t) >= quality.MIN_JUDGED_CHARS else {}
        if n >= quality.MIN_JUDGED_WORDS:
            out["share"] = js([sum(common[:-1]), common[-1]], [sum(ref[:-1]), ref[-1]])
            if sum(common[:-1]) >= quality.MIN_JUDGED_COMMON:
                out["word"] = js(common[:-1], ref[:-1])
        return {kind: math.floor(round(v, 8) * quality.STEPS) for kind, v in out.items()}

    far = {d: distances(d, t, lang) for d, t, lang, _ in docs}
    limits = {}
    for lang in words:
        for kind, (times, least, otherwise) in quality.LIMITS.items():
            x = sorted(far[d][kind] for d, _, lang_, _ in docs if lang_ == lang and not base[d][5] and kind in far[d])
            enough = len(x) >= quality.MIN_LIMIT_DOCS
            middle, quartile = (x[-(-len(x) // 2) - 1], x[-(-3 * len(x) // 4) - 1]) if enough else (0, 0)
            limits[lang, kind] = max(middle + times * (quartile - middle), least) if enough else otherwise
    return {d: not base[d][5] and all(v <= limits[lang, kind] for kind, v in far[d].items()) for d, _, lang, _ in docs}


def plain(text):
    return " " + " ".join(re.sub(r"[^\w\s]", "", text).lower().split()) + " "


def test_quality_limits_of_each_language_against_brute_force(spark, monkeypatch):
    """Limits from at least 100 documents a language; each of the three distances rejects a document of its own."""
    rng = random.Random(17)
    fill = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    docs = []
    for k, lang in enumerate(("en", "de")):
        vocabulary = list(quality.COMMON_WORDS[lang]) * 12 + fill
        docs += [(1000 * k + i, prose(rng, rng.randint(200, 400), vocabulary), lang, "s") for i in range(120)]
    docs.append((901, prose(rng, 200, fill), "en", "s"))
    docs.append((902, " ".join("the" if i % 3 == 0 else fill[i * 7 % 300] for i in range(300)), "en", "s"))
    docs.append((903, prose(rng, 200, [*quality.COMMON_WORDS["en"] * 12, *[f"{w}$$%%##&&" for w in fill]]), "en", "s"))
    docs += [(2000 + i, prose(rng, 200, fill), "fr", "s") for i in range(20)]
    df = docs_df(spark, [(d, t, source, lang) for d, t, lang, source in docs])
    got = {r.doc_id: r for r in quality.judge_quality(df).collect()}
    want = brute_quality(docs)
    assert {d: r.kept for d, r in got.items()} == want
    assert [d for d in want if not want[d]] == [901, 902, 903]
    assert got[901].word_distance is None and got[902].word_distance > 0.5 and got[903].char_distance > 0.2
    # one limit a distance, each wide open but one
    for d, kind in ((901, "share"), (902, "word"), (903, "char")):
        monkeypatch.setattr(quality, "LIMITS", {k: v if k == kind else (v[0], quality.STEPS, quality.STEPS) for k, v in quality.LIMITS.items()})
        assert not {r.doc_id: r.kept for r in quality.judge_quality(df).collect()}[d], kind
        monkeypatch.undo()


def test_pipeline_against_brute_force(spark):
    source = spark.read.parquet(f"{HERE}/documents.parquet")
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in source.collect()]
    stages = dict(corpus_pipeline.STAGES)

    def stage(name, df):
        out = stages[name](spark, df, HERE)
        return spark.createDataFrame(out.collect(), out.schema)

    kept = brute_quality(docs)
    df = stage("quality", source)
    docs = [d for d in docs if kept[d[0]]]
    assert df.columns == source.columns
    assert sorted(r.doc_id for r in df.collect()) == sorted(d[0] for d in docs)

    components = brute_components(docs, 80)
    df = stage("near_dedup", df)
    docs = [d for d in docs if components[d[0]][2]]
    assert sorted(r.doc_id for r in df.collect()) == sorted(d[0] for d in docs)

    items = [plain(r.text) for r in spark.read.parquet(f"{HERE}/benchmark.parquet").collect()]
    df = stage("decontaminate", df)
    docs = [d for d in docs if not any(i in plain(d[1]) for i in items)]
    assert df.columns == source.columns
    assert sorted(r.doc_id for r in df.collect()) == sorted(d[0] for d in docs)

    sizes, taken = collections.Counter(), collections.Counter()
    for d, t, _, s in docs:
        sizes[s] += len(WORD.findall(t))
    df = stage("mix", df)
    assert df.columns == source.columns
    for r in df.collect():
        taken[r.source] += len(WORD.findall(r.text))
    assert max(collections.Counter(r.doc_id for r in df.collect()).values()) <= 2
    for s, target in brute_targets(sizes, mixture.WEIGHTS, mixture.SHARE, mixture.CAP).items():
        own = [len(WORD.findall(t)) for _, t, _, x in docs if x == s]
        best = 0 if len(own) > 9 else min(abs(sum(k * n for k, n in zip(pick, own)) - target) for pick in itertools.product(range(3), repeat=len(own)))
        assert abs(taken[s] - target) <= max(0.02 * target, 20, 1.5 * best)

    rows = df.collect()
    out = stages["shard"](spark, df, HERE).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == collections.Counter(
        (r.doc_id, len(r.text.encode()) + 1, zlib.crc32(r.text.encode())) for r in rows)
    slots = collections.defaultdict(list)
    load = collections.Counter()
    for r in out:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(load.values()) / 16
    assert max(abs(load[j] - mean) for j in range(16)) <= 4 * max(r.size for r in out)


def test_pipeline_decides_by_row_not_by_id(spark, scratch):
    rng = random.Random(19)
    item, *clean = (prose(rng, 60) for _ in range(8))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    rows = [(None, clean[0]), (None, clean[1]), (1, clean[2]), (1, clean[3]), (2, clean[4]), (2, "too short"), (3, clean[5]), (3, clean[5]),
            (None, clean[5]), (4, clean[6]), (4, item), (None, item), (None, "short too")]
    df, texts = docs_df(spark, rows), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        columns, df = df.columns, stage(spark, df, scratch)
        assert df.columns == columns
        df = spark.createDataFrame(df.collect(), df.schema)
        texts[name] = sorted((r.doc_id or 0, r.text) for r in df.collect())
    long = sorted((d or 0, t) for d, t in rows if len(t) > 20)
    assert texts["quality"] == long
    once = sorted({x for x in long if x != (0, clean[5]) and x != (0, item)})
    assert texts["near_dedup"] == once
    assert texts["decontaminate"] == [x for x in once if x[1] != item]
    assert {x for x in texts["mix"]} == set(texts["decontaminate"])


def test_pipeline_keeps_columns_with_clashing_names(spark, scratch):
    """Every stage returns each row's own values, whatever its columns are called."""
    rng = random.Random(29)
    spark.createDataFrame([(1, prose(rng, 60))], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    names = ["row", "repeats", "digest_a", "digest_b", "shard", "slot", "kind", "hash", "item_id", "place", "group", "first", "size", "kept", "a", "b",
             "pipeline_row", "pipeline_digest_a", "Pipeline_Digest_B", "pipeline_times", "component_id", "n_shingles", "target", "taken", "rank"]
    near = prose(rng, 100)
    texts = [prose(rng, 80) for _ in range(6)] + [near, near + " one more"]
    rows = [(i, t, "en", "s", len(t), *[1000 * i + j for j in range(len(names))]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} long" for n in names))
    want = {r[0]: r for r in rows}
    for name, stage in corpus_pipeline.STAGES[:4]:
        columns, df = df.columns, stage(spark, df, scratch)
        assert df.columns == columns
        got = df.collect()
        assert all(tuple(r) == want[r.doc_id] for r in got), name
        ids = {r.doc_id for r in got}
        assert ids <= set(want) - {7} and ids if name == "mix" else ids == set(want) - ({7} if name != "quality" else set()), name
        df = spark.createDataFrame(got, df.schema)
    assert {r.doc_id for r in corpus_pipeline.STAGES[4][1](spark, df, scratch).collect()} == ids


def test_pipeline_passes_empty_and_odd_tables(spark, scratch):
    spark.read.parquet(f"{HERE}/benchmark.parquet").write.parquet(f"{scratch}/benchmark.parquet")
    for name, rows in (("empty", []), ("odd", [(None, "no id"), (1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "word " * 3000, None, None)])):
        d = f"{scratch}/{name}"
        docs_df(spark, rows).write.parquet(f"{d}/documents.parquet")
        spark.read.parquet(f"{scratch}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
        assert corpus_pipeline.run(spark, d).collect() == []
