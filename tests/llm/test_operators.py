"""Small-table behaviour of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from clickpath.llm import decontaminate, hmm, licences, linededup, mixture, neardup, preference, quality, queries, reshard, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, block int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALL_DOC_OPERATORS = {
    "quality": quality.judge_quality, "reshard": reshard.reshard, "mix": mixture.mix_sources, "near": neardup.near_duplicate_groups,
    "lines": linededup.line_digests, "hmm": lambda d: hmm.score_documents(d, states=2, rounds=1), "secrets": secrets.scan_secrets,
}


def docs_df(spark, rows):
    """rows: (doc_id, text[, source[, lang]]); the other columns clash with names that operators use inside."""
    full = [(r[0], r[1], (r[3] if len(r) > 3 else "en"), (r[2] if len(r) > 2 else "s"), 0, -1, "x", 7) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def prose(rng, n, vocabulary=None):
    vocabulary = vocabulary or [f"w{i}" for i in range(200)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward(seed=1):
    rng = random.Random(seed)
    base = prose(rng, 120)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One two\x0bthree four"), (6, "a b c d e"), (7, base), (8, base),
            (9, base + " extra"), (10, prose(rng, 30_000)), (11, "x" * 50_000), (12, "é" * 45 + "\n" + "É" * 45), (None, "no id here"),
            (13, "same row"), (13, "same row"), (None, None), (14, base, None), (15, prose(rng, 60), "", None)]
    return rows


@pytest.mark.parametrize("name", sorted(ALL_DOC_OPERATORS))
def test_one_row_per_document_and_empty_table(spark, name):
    operator = ALL_DOC_OPERATORS[name]
    rows = awkward()
    got = operator(docs_df(spark, rows)).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    assert operator(docs_df(spark, [])).collect() == []


# --- quality ---------------------------------------------------------------------------------------------------

def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    marked = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, r = len(w), len(marked)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n)


def test_quality_base_metrics_against_brute_force(spark):
    rng = random.Random(4)
    rows = awkward()[:12] + [(100 + i, "\n".join(prose(rng, rng.randint(0, 9), list("abc#|é")) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    got = {r.doc_id: tuple(r)[1:7] for r in quality.judge_quality(docs_df(spark, rows)).collect()}
    assert got == {d: brute_base(t) for d, t, *_ in rows}


def test_quality_drops_a_foreign_distribution_and_keeps_prose(spark):
    rng = random.Random(5)
    common = list(quality.COMMON_WORDS["en"]) * 6
    vocabulary = common + ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows = [(i, prose(rng, 150, vocabulary)) for i in range(60)]
    rows += [(1000, " ".join(f"{rng.randint(0, 10**9)}###" for _ in range(150))), (1001, " ".join(f"Q{i}!!" for i in range(150)).upper())]
    got = {r.doc_id: r for r in quality.judge_quality(docs_df(spark, rows)).collect()}
    assert all(got[i].kept for i in range(60))
    assert not got[1000].base_failed and not got[1000].kept
    assert not got[1001].kept


def test_js_distance_values(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0], [3.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>, c array<double>, z array<double>")
    r = df.select(quality.js_distance(F.col("a"), F.col("b")).alias("far"), quality.js_distance(F.col("a"), F.col("c")).alias("same"),
                  quality.js_distance(F.col("a"), F.col("z")).alias("none")).first()
    assert r.far == pytest.approx(1.0) and r.same == 0.0 and r.none is None


# --- reshard ---------------------------------------------------------------------------------------------------

def test_reshard_sizes_slots_and_least_moves(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(0, 40))) for i in range(3000)]
    got = reshard.reshard(docs_df(spark, rows)).collect()
    text = dict(rows)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    size = collections.Counter()
    slots = collections.defaultdict(list)
    olds = collections.Counter()
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        olds[r.old_shard] += r.size
    assert sorted(size) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(size.values()) / 16, max(r.size for r in got)
    assert max(abs(v - mean) for v in size.values()) <= 4 * largest
    least = sum(max(0, v - mean) for v in olds.values())
    moved = sum(r.size for r in got if r.old_shard != r.shard)
    assert abs(moved - least) <= 13 * largest
    again = reshard.reshard(docs_df(spark, rows[::-1])).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_reshard_spreads_a_repeated_row(spark):
    rng = random.Random(16)
    rows = [(i, prose(rng, rng.randint(5, 40))) for i in range(2000)]
    for repeated in ((None, prose(rng, 22)), (77_777, prose(rng, 22))):
        got = reshard.reshard(docs_df(spark, rows + [repeated] * 1000)).collect()
        assert collections.Counter(r.doc_id for r in got) == collections.Counter([d for d, _ in rows] + [repeated[0]] * 1000)
        size, slots = collections.Counter(), collections.defaultdict(list)
        for r in got:
            size[r.shard] += r.size
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        mean, largest = sum(size.values()) / 16, max(r.size for r in got)
        assert len(size) == 16 and max(abs(v - mean) for v in size.values()) <= 4 * largest


def test_reshard_rewrites_only_affected_shards(spark, scratch):
    from pyspark.sql import functions as F
    docs = docs_df(spark, [(i, "x" * 9) for i in range(400)])
    old = F.pmod("doc_id", F.lit(4)).cast("int")
    plan = reshard.reshard(docs, old, 5).cache()
    affected = reshard.rewrite_affected(docs, plan, f"{scratch}/out")
    assert affected == [0, 1, 2, 3, 4]
    back = spark.read.parquet(f"{scratch}/out")
    assert {(r.doc_id, r.shard) for r in back.select("doc_id", "shard").collect()} == {(r.doc_id, r.shard) for r in plan.collect()}
    still = reshard.reshard(docs, old, 4)
    assert reshard.rewrite_affected(docs, still, f"{scratch}/same") == []


def test_reshard_rewrites_null_ids_repeated_rows_and_fewer_shards(spark, scratch):
    from pyspark.sql import functions as F
    rows = [(i, f"text {i}") for i in range(200)] + [(None, f"no id {i % 20}") for i in range(60)] + [(7, "again")] * 30 + [(8, "one"), (8, "two")]
    docs = docs_df(spark, rows)
    old = F.pmod(F.xxhash64("text"), F.lit(6)).cast("int")
    for shards in (4, 8):
        out = f"{scratch}/out{shards}"
        docs.withColumn("shard", old).write.partitionBy("shard").parquet(out)
        plan = reshard.reshard(docs, old, shards)
        affected = reshard.rewrite_affected(docs, plan, out)
        assert shards > 4 or {4, 5} <= set(affected)
        back = spark.read.parquet(out).collect()
        assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter(rows)
        assert collections.Counter(r.shard for r in back) == collections.Counter(r.shard for r in plan.collect())


# --- mixture ---------------------------------------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(cap * sizes[s] for s in capped)
        target = {s: (cap * sizes[s] if s in capped else left * w[s] / sum(w[f] for f in free)) for s in names}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix_targets_and_fit(spark):
    rng = random.Random(8)
    sources = ["b", "a", "é", "B", None, ""]
    rows = [(i, prose(rng, rng.choice([0, 3, 5, 8, 8, 8, 21, 60])), "a" if i % 3 == 0 else rng.choice(sources)) for i in range(2000)]
    got = mixture.mix_sources(docs_df(spark, rows)).collect()
    words = {d: len(WORD.findall(t)) for d, t, _ in rows}
    sizes = collections.Counter()
    for d, t, s in rows:
        sizes[s] += words[d]
    target = brute_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r.size == words[r.doc_id] and r.source_size == sizes[r.source] and 0 <= r.repeats <= 2
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.repeats * r.size
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3
    again = mixture.mix_sources(docs_df(spark, rows[::-1])).collect()
    assert {(r.doc_id, r.repeats) for r in got} == {(r.doc_id, r.repeats) for r in again}


def test_mix_with_no_words_at_all(spark):
    got = mixture.mix_sources(docs_df(spark, [(1, None), (2, " ", None)])).collect()
    assert {(r.doc_id, r.size, r.target, r.repeats) for r in got} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


# --- decontamination -------------------------------------------------------------------------------------------

ITEM = "Tom bought 12 apples and 7 pears for 3 dollars at the market before Tom walked home with all of them in one bag"


def bench_df(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination_finds_copies_and_changed_values_only(spark):
    rng = random.Random(9)
    pad = lambda: prose(rng, 30)
    changed = ITEM.replace("Tom", "Anna").replace("12", "40").replace("7", "9").replace("3 dollars", "5 euros")
    broken = ITEM.replace("Tom bought", "Anna bought").replace("12", "40")
    rows = [(1, f"{pad()} {ITEM} {pad()}"), (2, f"{pad()}\n{changed}. {pad()}"), (3, f"{pad()} {broken} {pad()}"), (4, pad()), (5, None),
            (6, ""), (7, f"{pad()} {ITEM[:40]} {pad()}"), (8, ITEM), (8, ITEM), (None, ITEM), (9, f"{ITEM} {pad()} {ITEM}")]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs_df(spark, rows), bench_df(spark, [(1, ITEM), (2, None), (None, ITEM), (3, "short one")])).collect()}
    assert set(got) == {(1, 1), (2, 1), (8, 1), (9, 1)}
    assert got[1, 1].n_changed == 0 and got[1, 1].n_windows == got[1, 1].item_windows
    assert got[2, 1].n_changed >= 4
    empty = bench_df(spark, [])
    assert decontaminate.contaminated(docs_df(spark, rows), empty).collect() == []
    assert decontaminate.contaminated(docs_df(spark, []), bench_df(spark, [(1, ITEM)])).collect() == []


def test_decontamination_finds_copies_in_any_case_and_short_or_name_heavy_items(spark):
    rng = random.Random(18)
    pad = lambda: prose(rng, 30)
    names = "Anna Berta Clara Dora Emil Fritz Georg Hans Ida Jakob Karl Ludwig 12 13 14"
    street = "Die lange Straße führt vom Bahnhof über die Brücke bis zum alten Markt"
    items = [(1, ITEM), (2, names), (3, "What is 7 times 8"), (4, street)]
    rows = [(1, f"{pad()} {ITEM.upper()} {pad()}"), (2, f"{pad()} {ITEM.lower()} {pad()}"), (3, f"{pad()} {ITEM.title()}. {pad()}"),
            (4, f"{pad()} {names} {pad()}"), (5, f"{pad()} what IS 7 times 8? {pad()}"), (6, f"{pad()} What is 7 times 9 {pad()}"),
            (7, f"{pad()} {' '.join(ITEM.split()[4:18]).upper()} {pad()}"), (8, pad()), (9, f"{pad()} {street.upper()} {pad()}"),
            (10, f"{pad()} {' '.join(names.split()[::-1])} {pad()}")]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs_df(spark, rows), bench_df(spark, items)).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 3), (7, 1), (9, 4)}
    assert {k: r.n_changed for k, r in got.items() if r.n_changed} == {(6, 3): 1}


QUESTIONS = ["What is {a} plus {b} ?", "Solve for x: {a}x + {b} = {c}.", "How many apples does {n} have after eating {a} of {b} ?",
             "Convert {a} kilometers to meters.", "{n} buys {a} pens at {b} dollars each; how much does {n} pay ?",
             "A train leaves {m} at {a} km/h and reaches {n} in {b} hours. How far apart are the two cities along the line ?",
             "The sum of two consecutive numbers is {a}; find the larger of them.", "If {n} is {a} years old and {m} is twice that, how old is {m} ?",
             "A rectangle has a width of {a} cm and a length of {b} cm. What is its area in square units, and by how much does it exceed {c} ?",
             "Write {a} as a product of prime factors.", "{n} reads {a} pages a day; after how many days are {b} pages read ?"]


def test_reparameterised_items_are_found_and_idioms_are_not(spark):
    rng = random.Random(23)
    names = ["Anna", "Boris", "Clara", "Dmitri", "Elena", "Farid", "Greta", "Hassan"]

    def fill(q):
        n, m = rng.sample(names, 2)
        return q.format(a=rng.randint(2, 99), b=rng.randint(100, 999), c=rng.randint(1000, 9999), n=n, m=m)

    items = [(i, fill(q)) for i, q in enumerate(QUESTIONS)]
    rows, want = [], set()
    for i, q in enumerate(QUESTIONS):
        for j in range(10):
            rows.append((100 * i + j, f"{prose(rng, rng.randint(0, 40))} {fill(q)} {prose(rng, rng.randint(0, 40))}"))
            want.add((100 * i + j, i))
    rows += [(5000 + i, prose(rng, 60)) for i in range(50)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs_df(spark, rows), bench_df(spark, items)).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)
    # a slot that stands for two values at once is no copy
    wrong = [(1, "If Lena is 30 years old and Omar is twice that, how old is Vera ?")]
    assert decontaminate.contaminated(docs_df(spark, wrong), bench_df(spark, items)).collect() == []
    # a short template that very many documents hold is an idiom; its literal copies are still copies
    many = [(i, f"{prose(rng, 5)} What is {i} plus {i + 1} ? {prose(rng, 5)}") for i in range(decontaminate.COMMON_DOCS + 5)] + [(900, "so " + items[0][1])]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs_df(spark, many), bench_df(spark, items)).collect()}
    assert got == {(900, 0)}


def test_short_templates_of_many_documents_are_all_found(spark, tmp_path):
    """Every filled copy counts in the query, also beyond COMMON_DOCS documents."""
    rng = random.Random(29)
    n = decontaminate.COMMON_DOCS + 15
    docs = [(i, f"{prose(rng, 5)} What is {i} plus {i + 1} ? {prose(rng, 5)}") for i in range(n)] + [(900, prose(rng, 30))]
    docs_df(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    bench_df(spark, [(0, "What is 7 plus 205 ?"), (1, ITEM)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op4_template_decontamination(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, 0) for i in range(n)]
    assert all(r.n_changed == 2 for r in got if r.doc_id != 7)


def test_decontamination_of_odd_rows(spark):
    long = " ".join(["filler"] * 60_000) + " " + ITEM + " tail" * 50_000
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, ITEM), (4, "x" * 300_000), (5, ITEM), (5, "other text"), (6, " ".join([ITEM] * 3))]
    items = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (None, ITEM)]
    got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs_df(spark, rows), bench_df(spark, items)).collect()]
    assert sorted(got) == [(1, 1), (5, 1), (6, 1)]


def test_decontamination_shuffle_join_gives_the_same(spark, monkeypatch):
    docs, bench = docs_df(spark, [(1, ITEM), (2, "nothing " * 30)]), bench_df(spark, [(1, ITEM)])
    first = decontaminate.contaminated(docs, bench).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert decontaminate.contaminated(docs, bench).collect() == first


# --- licences --------------------------------------------------------------------------------------------------

def test_licence_families_unknown_and_ordinary(spark):
    rng = random.Random(10)
    vocabulary = ["the", "of", "and", "to", "a", "in", "is", "by", "for", "this", "work", "under", "file"] + [f"w{i}" for i in range(100)]
    notices = {1: ("Released under the MIT License.", "mit"), 2: ("Licensed under the Apache License, Version 2.0.", "apache"),
               3: ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
               4: ("Licensed under CC BY-NC 4.0.", "creative_commons"), 5: ("All rights reserved.", "proprietary"),
               6: ("Licensed under the Frobnicate Public Source Agreement.", "unknown")}
    rows = [(d, f"{prose(rng, 40, vocabulary)}\n{n}\n{prose(rng, 40, vocabulary)}") for d, (n, _) in notices.items()]
    rows += [(100 + i, "\n".join(prose(rng, 30, vocabulary) for _ in range(5))) for i in range(60)] + [(200, None), (201, ""), (None, "MIT License")]
    got = collections.defaultdict(list)
    for r in licences.find_licences(docs_df(spark, rows)).collect():
        got[r.doc_id].append((r.paragraph, r.family))
    assert {d: v for d, v in got.items() if d in notices} == {d: [(1, f)] for d, (_, f) in notices.items()}
    assert not [d for d in got if d is not None and d >= 100]


MIT_80_COLUMNS = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""


def test_licence_notices_as_they_stand_in_files(spark):
    """Plain names, identifiers, wrapped and unwrapped notices; ordinary sentences with their words; very long, repeated and tied rows."""
    rng = random.Random(17)
    vocabulary = ["the", "of", "and", "to", "a", "in", "is", "by", "for", "this", "work", "under", "file", "software"] + [f"w{i}" for i in range(100)]
    wanted = {"MIT License": "mit", "SPDX-License-Identifier: MIT": "mit", "// SPDX-License-Identifier: GPL-2.0-only": "gpl",
              "SPDX-License-Identifier: Apache-2.0": "apache", "The MIT License (MIT)": "mit", MIT_80_COLUMNS.replace("\n", " "): "mit",
              "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
              "Redistribution and use in source and binary forms, with or without": "bsd", "BSD 3-Clause License": "bsd",
              "Copyright 2019 Example Corp. All rights reserved.": "proprietary", "Eclipse Public License v2.0": "unknown",
              "you may not use this file except in compliance with the License.": "apache", "Apache License, Version 2.0": "apache",
              "it under the terms of the GNU General Public License as published by": "gpl", "Mozilla Public License 2.0": "mozilla",
              "License, v. 2.0. If a copy of the MPL was not distributed with this": "mozilla", "CC BY-SA 4.0": "creative_commons",
              "SPDX-License-Identifier: EPL-2.0": "unknown", "Licensed under the Quux Community License": "unknown"}
    ordinary = ["A taxi driver showed a license to the officer.", "The apache helicopter landed in the field.", "MIT students won the prize.",
                "The seats were reserved for the guests of the court.", "Copyright law was changed by the parliament last year.",
                "The general public may visit the garden free of charge.", "This software is used in many schools."]
    lines = list(wanted)
    rows = [(i, f"{prose(rng, 40, vocabulary)}\n{line}\n{prose(rng, 40, vocabulary)}") for i, line in enumerate(lines)]
    rows += [(50, MIT_80_COLUMNS), (50, MIT_80_COLUMNS), (60, "\n".join([prose(rng, 30, vocabulary)] * 4000 + ["MIT License"]))]
    rows += [(100 + i, line) for i, line in enumerate(ordinary)] + [(200 + i, "\n".join(prose(rng, 30, vocabulary) for _ in range(5))) for i in range(60)]
    got = collections.defaultdict(list)
    for r in licences.find_licences(docs_df(spark, rows)).collect():
        got[r.doc_id].append((r.paragraph, r.family))
    found = {line: got.get(i) for i, line in enumerate(lines)}
    assert found == {line: [(1, family)] for line, family in wanted.items()}
    wrapped = collections.Counter(got[50])
    assert set(wrapped.values()) == {2} and {p for p, f in wrapped if f == "mit"} >= {0, 1, 2, 3, 4} and {f for _, f in wrapped} <= {"mit", "unknown"}
    assert got[60] == [(4000, "mit")]
    assert not [d for d in got if d >= 100]


def test_licence_recall_and_false_alarms_by_family(spark):
    """Pieces of every notice at other widths, in other case: nine in ten lines name their family; ordinary lines none."""
    from clickpath.llm.wordings import FAMILIES
    rng = random.Random(18)
    rows, family_of = [], {}
    for family, (names, _, text) in FAMILIES.items():
        w = text.split()
        pieces = [" ".join(w[i:i + 11]) for i in range(0, max(1, len(w) - 10), 11)] + [f"This code is available under the {n}" for n in names]
        if family == "proprietary":
            pieces = pieces[:3] + [f"Copyright {y} Sample Press. All rights reserved." for y in (1999, 2011, 2024)]
        for piece in pieces:
            family_of[len(rows)] = family
            rows.append((len(rows), rng.choice([piece, piece.upper()])))
    vocabulary = ["the", "of", "and", "to", "a", "in", "is", "by", "for", "this", "may", "be", "with", "or"] + [f"w{i}" for i in range(100)]
    rows += [(1000 + i, prose(rng, 25, vocabulary)) for i in range(300)]
    got = {r.doc_id: r.family for r in licences.find_licences(docs_df(spark, rows)).collect()}
    for family in FAMILIES:
        mine = [d for d, f in family_of.items() if f == family]
        assert sum(got.get(d) == family for d in mine) >= 0.9 * len(mine), (family, [rows[d][1] for d in mine if got.get(d) != family])
    assert not [d for d in got if d >= 1000]


def test_licences_of_an_empty_table(spark):
    assert licences.find_licences(docs_df(spark, [])).collect() == []


# --- near duplicates -------------------------------------------------------------------------------------------

def brute_components(rows, pct=85):
    sets = {}
    for d, t, *_ in rows:
        w = WORD.findall(lower(t or ""))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= pct * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for g in range(12):
        base = prose(rng, rng.choice([3, 8, 40, 200]))
        rows += [(None, edited(rng, base, rng.choice([0, 0, 1, 2, 3, 6]))) for _ in range(rng.choice([1, 2, 5, 40]))]
    rows = [(i, t) for i, (_, t) in enumerate(rng.sample(rows, len(rows)))] + [(900, None), (901, ""), (902, ""), (903, "A b"), (904, "a B")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicate_groups(docs_df(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_in_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(12)
    base = prose(rng, 120)
    rows = [(i, edited(rng, base, rng.choice([0, 1, 1, 2, 2, 4]))) for i in range(90)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicate_groups(docs_df(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_of_different_texts_under_one_id(spark):
    rng = random.Random(21)
    first, second, third = (prose(rng, 120) for _ in range(3))
    rows = [(1, first), (1, second), (1, third), (5, edited(rng, first, 1)), (7, edited(rng, second, 1)), (0, edited(rng, third, 1)), (9, "alone")]
    got = collections.Counter((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicate_groups(docs_df(spark, rows)).collect())
    assert got == collections.Counter([(1, 1, True), (1, 1, True), (1, 0, False), (5, 1, False), (7, 1, False), (0, 0, True), (9, 9, True)])


def test_near_duplicates_whose_cut_coordinates_collide_in_an_earlier_band():
    import numpy as np
    import pyarrow as pa
    cut = np.tile(np.arange(neardup.COORDINATES, dtype=np.uint16), (2, 1))
    bands = neardup.COORDINATES // neardup.ROWS
    keys = np.tile(np.arange(bands, dtype=np.int64), (2, 1))
    keys[1, :3] += 1000
    for band in range(bands):
        table = pa.table({"coords": [x.tobytes() for x in cut], "bands": keys.tolist(), "side": [0, 0], "band": [band] * 2})
        found = [x.tolist() for x in neardup._cell_pairs(table, 0, 2, 60)]
        assert found == ([[0], [1]] if band == 3 else [[], []])


def test_estimate_floor_loses_fewer_links_than_the_bands():
    for pct in (80, 85, 90):
        p, need = pct / 100, neardup._estimate_floor(pct)
        below = lambda n: sum(math.comb(96, k) * p**k * (1 - p)**(96 - k) for k in range(n))
        assert below(need) < 1e-8 <= below(need + 1)


def test_connected_components_of_a_long_path(spark):
    n = 70
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in neardup.connected_components(links).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
    assert neardup.connected_components(links.limit(0)).collect() == []


# --- line dedup ------------------------------------------------------------------------------------------------

def brute_lines(rows, least=40, docs=5):
    key = lambda s: lower(s.strip(" \t\n\x0b\x0c\r"))
    at = collections.defaultdict(set)
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                at[key(line)].add(d)
    out = {}
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(at.get(key(x), ())) >= docs and max(at[key(x)]) != d)]
        out[d] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("partitions", ["2", "23"])
def test_line_dedup_against_brute_force(spark, partitions):
    rng = random.Random(13)
    pool = [prose(rng, 12) for _ in range(25)] + ["  " + "É" * 40 + "\r", "é" * 39]
    hot = "Everyone shares this very common line of at least forty characters"
    rows = []
    for i in range(200):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 6))] + ["\t" + rng.choice([hot, hot.upper(), hot + " "])] * rng.randint(0, 3)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: tuple(r)[1:] for r in linededup.line_digests(docs_df(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_lines(rows)


def test_line_dedup_of_different_texts_under_one_id(spark):
    shared, unique = "A line of forty characters or more that documents share", "A line of forty characters or more that stands alone"
    rows = [(1, f"{shared}\n{unique}"), (1, f"{unique} too\n{shared}"), (1, f"{shared}\n{unique}")] + [(i, shared) for i in range(2, 7)]
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = collections.Counter(tuple(r) for r in linededup.line_digests(docs_df(spark, rows)).collect())
    assert got == collections.Counter({(1, 2, 1, digest(unique)): 2, (1, 2, 1, digest(unique + " too")): 1, (6, 1, 0, digest(shared)): 1}
                                      | {(i, 1, 1, digest("")): 1 for i in range(2, 6)})


def test_keep_bitmaps_round_trip():
    import numpy as np
    text = "a\nb\nc\nd"
    keep = np.array([1, 0, 1, 1, 1, 1, 1, 1], bool)
    assert linededup.kept_text(text, zlib.compress(np.packbits(keep).tobytes())) == "a\nc\nd"
    assert linededup.kept_text(text, None) == text


# --- hidden Markov model ---------------------------------------------------------------------------------------

def brute_forward(model, buckets):
    """Sum over all state paths, one token at a time, without scaling."""
    a = [model.start[k] * model.emit[k][buckets[0]] for k in range(len(model.start))]
    for b in buckets[1:]:
        a = [sum(a[j] * model.move[j][k] for j in range(len(a))) * model.emit[k][b] for k in range(len(a))]
    return sum(a)


def test_forward_and_expected_counts_against_brute_force():
    import itertools

    import numpy as np
    rng = np.random.default_rng(2)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = hmm.Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 5))))
    lengths = np.array([1, 4, 2, 5])
    tokens = rng.integers(0, 5, lengths.sum())
    packed = hmm.pack(lengths, np.cumsum(lengths) - lengths)
    mine = tokens[packed.at]
    scale, _ = hmm.forward(model, model.emit.T[mine], packed, False)
    who = np.arange(packed.offset[-1]) - np.repeat(packed.offset[:-1], packed.active)
    got = np.exp(np.bincount(who, np.log(scale)))
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for i, p in zip(packed.order, got):
        begin = lengths[:i].sum()
        text = tokens[begin:begin + lengths[i]]
        total = brute_forward(model, text)
        assert p == pytest.approx(total)
        for path in itertools.product(range(3), repeat=len(text)):
            w = model.start[path[0]] * model.emit[path[0], text[0]]
            for s, t, b in zip(path, path[1:], text[1:]):
                w *= model.move[s, t] * model.emit[t, b]
            w /= total
            start[path[0]] += w
            for s, b in zip(path, text):
                emit[s, b] += w
            for s, t in zip(path, path[1:]):
                move[s, t] += w
    s, m, gamma = hmm.expected_counts(model, mine, packed)
    assert s == pytest.approx(start) and m == pytest.approx(move)
    assert np.array([np.bincount(mine, gamma[:, k], 5) for k in range(3)]) == pytest.approx(emit)


def test_hmm_base_columns_against_brute_force_and_gain_on_held_out_text(spark):
    rng = random.Random(14)
    topics = [[f"t{k}w{i}" for i in range(40)] for k in range(3)]
    rows = [(i, prose(rng, rng.randint(20, 60), topics[i % 3])) for i in range(600)] + [(700, None), (701, ""), (702, "never seen words")]
    got = {r.doc_id: r for r in hmm.score_documents(docs_df(spark, rows), states=4, rounds=5).collect()}
    tokens = {d: [lower(w) for w in WORD.findall(t or "")] + [None] for d, t, *_ in rows}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in tokens}
    c = collections.Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, distinct = sum(c.values()), len(c)
    for d, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(tokens[d]), sum(c[w] > 0 for w in tokens[d]), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens[d]))
        assert r.score < 0
    unseen = [d for d in got if held[d]]
    assert sum(got[d].score for d in unseen) > sum(got[d].base_score for d in unseen) + 50


# --- preference pairs ------------------------------------------------------------------------------------------

def test_preference_prefix_masks_and_pairing(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "more"), (1, 3, "assistant", "long answer"),
             (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "less"), (3, 0, "user", "alone"), (3, 1, "assistant", "yes"),
             (4, 0, None, None), (None, 0, "user", "lost"), (3, 1, "assistant", "yes"), (5, None, "user", "q")]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, opening string")
    got = {r.conv_id: r for r in preference.preference_examples(df).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    r = got[2]
    assert (r.other_id, r.n_prompt_turns) == (1, 2)
    assert r.prompt == "<|user|>\nhi\n<|end|>\n<|assistant|>\nhello\n<|end|>\n"
    assert r.prompt + r.chosen == "".join(f"<|{role}|>\n{text}\n<|end|>\n" for c, _, role, text in turns if c == 1)
    assert [r.chosen[m.start:m.end] for m in r.chosen_mask] == ["long answer\n<|end|>\n"]
    assert r.rejected == "<|user|>\nless\n<|end|>\n" and r.rejected_mask == []
    assert got[1].other_id is None and got[1].n_prompt_turns == 3
    assert [got[1].rejected[m.start:m.end] for m in got[1].rejected_mask] == ["hello\n<|end|>\n"]
    assert got[3].rejected == "<|assistant|>\n\n<|end|>\n" and got[3].chosen == "<|assistant|>\nyes\n<|end|>\n"
    assert got[4].chosen == got[4].rejected == ""
    assert preference.preference_examples(df.limit(0)).collect() == []


# --- secrets ---------------------------------------------------------------------------------------------------

def brute_spans(text):
    out = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secret_spans_against_brute_force(spark):
    rng = random.Random(15)
    names = [f"config_{a}_{b}" for a in ("user", "server", "client", "window") for b in ("name", "count", "limit")]
    key = "".join(rng.choice(secrets.SYMBOLS[:62]) for _ in range(44))
    hexkey = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    special = [f"passWORD = '{hexkey}' ok", 'api_key:"abc.def-123"', "token=short", "AKIA" + "A1B2" * 4, "AKIA12", "é secret : " + hexkey, hexkey,
               f"key {key} end", "tokentoken=12345678", "paſſword=12345678", "x" * 64, ""]
    rows = [(i, f"{prose(rng, 50, names)} {s} {prose(rng, 20, names)}") for i, s in enumerate(special)] + [(90, None)]
    rows += [(100 + i, prose(rng, 200, names + ["ordinary", "sentences", "with", "internationalization_of_everything"])) for i in range(40)]
    got = {r.doc_id: r for r in secrets.scan_secrets(docs_df(spark, rows)).collect()}
    for d, t, *_ in rows:
        base = brute_spans(t or "")
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        r = got[d]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        extra = [x for x in r.spans.split(",") if x.startswith("markov")]
        assert [x for x in r.spans.split(",") if x and x not in extra] == ([x for x in joined.split(",") if x])
        if d == 7:
            s, e = map(int, extra[0].split(":")[1:])
            assert t[s:e] == key
        elif d >= 90:
            assert not extra


def test_markov_spans_beside_many_overlapping_spans_against_brute_force():
    import numpy as np
    rng = random.Random(16)
    text = " ".join("x" * rng.choice([5, 20, 33]) for _ in range(300))
    taken = sorted((s, rng.randrange(3), s + rng.choice([1, 8, 90])) for s in rng.sample(range(len(text)), 40))
    runs = [m.span() for m in re.finditer("x{20,}", text)]
    free = [(s, 3, e) for s, e in runs if not any(a < e and s < b for a, _, b in taken)]
    assert free and len(free) < len(runs)
    assert secrets.markov_spans(text, taken, np.full((secrets._N, secrets._N), 9.0)) == free
    assert secrets.markov_spans(text, [], np.full((secrets._N, secrets._N), 9.0)) == [(s, 3, e) for s, e in runs]
