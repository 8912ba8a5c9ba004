"""Quality rules: distribution divergence from language references (native columns only).

Each document is a histogram over character classes, one over the common words
of its language, and the share of these among all its words.  References are
the same histograms summed over all documents of the language that pass the
base rules.  A document stays if all three Jensen-Shannon distances (base 2, so
0 .. 1) are within the limits of its language: the median distance of its
documents plus a multiple of the step from there to the upper quartile.
Histograms of short documents or thin references are not judged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickpath.llm.columns import NOT_SPACE, let, window_hashes, words
from clickpath.llm.storage import materialize

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5

MIN_JUDGED_CHARS = 300
MIN_JUDGED_WORDS = 50
MIN_REFERENCE_WORDS = 2_000
MIN_JUDGED_COMMON = 30
# Distances are compared in whole steps of 1 / STEPS, so that quantiles come from bounded counts.
STEPS = 10_000
MIN_LIMIT_DOCS = 100
# Of each distance: the multiple of the spread, the least limit, and the limit where a language has too few documents.
LIMITS = {"char": (60, 1500, 2800), "share": (8, 1000, 2500), "word": (8, 5000, 8000)}

# The characters of each class.  Two classes follow: UTF-8 bytes beyond one a character, which stand
# for letters outside ASCII, and the rest (lower-case a-z and other ASCII).
CLASSES = {
    " ": " \t\n\x0b\x0c\r",
    "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0": "0123456789",
    ".": ".,;:!?'\"()-",
    "#": "#*$%&|<>",
}
BINS = len(CLASSES) + 2

# Common words of each language
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"),
}


def repeated_words(hashes: Column) -> Column:
    """Words covered by windows that occur at least twice, from the window hashes in order.

    Equal hashes are neighbours after sorting (hash, position); the positions
    of such windows, sorted again, cover min(5, step to the next) words each.
    """
    def covered(pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        again = F.filter(pairs, lambda p, i: same(p, F.get(pairs, i - 1)) | same(p, F.get(pairs, i + 1)))
        return let(F.sort_array(F.transform(again, lambda p: p["i"])), lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda a, b: a + b))

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        let(F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda s: F.rlike(s, F.lit(NOT_SPACE)))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def class_marks(text: Column) -> Column:
    """The text with every character of a class replaced by the mark of the class."""
    return F.translate(text, "".join(CLASSES.values()), "".join(mark * len(chars) for mark, chars in CLASSES.items()))


def class_counts(text: Column, marks: Column) -> Column:
    """Characters of each class, then bytes beyond one a character, then the rest."""
    found = [F.length(marks) - F.length(F.replace(marks, F.lit(m))) for m in CLASSES]
    extra = F.octet_length(text) - F.length(text)
    counts = [c.cast("long") for c in [*found, extra]]
    return let(F.array(*counts), lambda n: F.concat(n, F.array(F.octet_length(text) - F.aggregate(n, F.lit(0).cast("long"), lambda a, b: a + b))))


def common_counts(tokens: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, as written or capitalised, the other words last (unknown language: null)."""
    def times(found: Column, word: str) -> Column:
        return F.size(F.filter(found, lambda w: w.isin(word, word.capitalize()))).cast("long")

    def of(vocabulary: tuple[str, ...]) -> Column:
        common = F.filter(tokens, lambda w: w.isin(*vocabulary, *[v.capitalize() for v in vocabulary]))
        counts = let(common, lambda c: F.array(*[times(c, v) for v in vocabulary], F.size(c).cast("long")))
        return let(counts, lambda n: F.concat(F.slice(n, 1, len(vocabulary)), F.array(F.size(tokens) - F.get(n, F.lit(len(vocabulary))))))

    out = F.lit(None).cast("array<bigint>")
    for name, vocabulary in COMMON_WORDS.items():
        out = F.when(lang == name, of(vocabulary)).otherwise(out)
    return out


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of counts; null if one is null or empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    share = lambda x: let(total(x), lambda t: F.transform(x, lambda v: v / F.nullif(t, F.lit(0.0))))
    term = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    parts = let(share(p), lambda a: let(share(q), lambda b: F.zip_with(
        a, b, lambda x, y: let((x + y) / 2, lambda m: (term(x, m) + term(y, m)) / 2))))
    # eight digits: the same on every engine whatever the order of the sum
    return F.when(total(p) * total(q) > 0, F.round(F.sqrt(F.greatest(total(parts), F.lit(0.0))), 8))


def features(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, lang, base metrics, both histograms and the columns to carry; texts do not go on."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"), *carry)
    rows = rows.select("*", words(F.col("text")).alias("tokens"), class_marks(F.col("text")).alias("marks"))
    rows = rows.select("*", window_hashes(F.col("tokens"), WINDOW).alias("windows"))
    symbols, space = (list(CLASSES).index(m) for m in "# ")
    rows = rows.select(
        "doc_id", "lang", F.size("tokens").cast("long").alias("n_words"), duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("windows")).alias("n_repeat_words"), F.length("text").cast("long").alias("chars"),
        class_counts(F.col("text"), F.col("marks")).alias("classes"), common_counts(F.col("tokens"), F.col("lang")).alias("common"), *carry)
    return materialize(rows.select(
        "doc_id", "lang", "n_words", (F.col("chars") - F.col("classes")[space]).alias("word_chars"),
        F.col("classes")[symbols].alias("n_symbols"), "n_dup_lines", "n_repeat_words", "chars", "classes", "common",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))).alias("base_failed"), *carry),
        "quality")


def references(rows: DataFrame) -> DataFrame:
    """(ref_lang, ref_classes, ref_common): mean histograms of the documents of a language that pass the base rules.

    Every document weighs the same, in millionths, so that sums are exact and
    one very long document does not set the reference.
    """
    def weighed(name: str) -> Column:
        x = F.col(name)
        total = F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)
        return F.transform(x, lambda v: F.floor(v * F.lit(1_000_000) / F.nullif(total, F.lit(0))))

    ok = rows.where("not base_failed").select("lang", "n_words", weighed("classes").alias("classes"), weighed("common").alias("common"))
    summed = lambda name, bins: F.array(*[F.sum(F.get(F.col(name), F.lit(i))).cast("double") for i in range(bins)])
    common_bins = len(next(iter(COMMON_WORDS.values()))) + 1
    return (ok.groupBy("lang").agg(F.sum("n_words").alias("n"), summed("classes", BINS).alias("ref_classes"),
                                   summed("common", common_bins).alias("ref_common"))
            .where(F.col("n") >= MIN_REFERENCE_WORDS).select(F.col("lang").alias("ref_lang"), "ref_classes", "ref_common"))


def limits(far: DataFrame) -> DataFrame:
    """(limit_lang, char_limit, share_limit, word_limit) in steps, of the documents that pass the base rules (null: too few).

    Documents are counted by language, distance and step first, so a window
    orders at most ``STEPS`` + 1 rows however many documents a language has.
    """
    scores = F.array(*[F.struct(F.lit(kind).alias("kind"), steps(F.col(f"{kind}_distance")).alias("at")) for kind in LIMITS])
    counts = far.where("not base_failed").select("lang", F.inline(scores)).where("at is not null").groupBy("lang", "kind", "at").agg(F.count("*").alias("n"))
    group = Window.partitionBy("lang", "kind")
    below = group.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select("lang", "kind", "at", F.sum("n").over(below).alias("upto"), F.sum("n").over(group).alias("n"))
    middle = ranked.where(F.col("n") >= MIN_LIMIT_DOCS).groupBy("lang", "kind").agg(
        F.min(F.when(2 * F.col("upto") >= F.col("n"), F.col("at"))).alias("median"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("n"), F.col("at"))).alias("quartile"))

    def of(kind: str) -> Column:
        times, least, _ = LIMITS[kind]
        limit = F.greatest(F.col("median") + times * (F.col("quartile") - F.col("median")), F.lit(least))
        return F.max(F.when(F.col("kind") == kind, limit)).alias(f"{kind}_limit")

    return middle.groupBy(F.col("lang").alias("limit_lang")).agg(*map(of, LIMITS))


def steps(distance: Column) -> Column:
    return F.floor(distance * STEPS)


def join_language(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the row of their language, broadcast where the languages are few (counted)."""
    table = F.broadcast(table) if table.count() <= 10_000 else table
    return rows.join(table, rows["lang"].eqNullSafe(table[key]), "left")


def judge_quality(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, char_distance, share_distance, word_distance, and the columns to carry.

    A null or empty text has no words and fails the base rules.  A null or
    unknown language is its own reference for characters and is not judged by
    common words; a distance that is not judged is null.  Null ids and repeated
    rows are judged like any other; an empty table gives no rows.
    """
    rows = features(docs, carry)
    as_double = lambda c: F.transform(c, lambda v: v.cast("double"))
    bins = len(next(iter(COMMON_WORDS.values())))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
    listed = lambda c: F.slice(c, 1, bins)
    share = lambda c: let(listed(c), lambda x: F.array(total(x), F.get(c, F.lit(bins))))
    far = join_language(rows, references(rows), "ref_lang")
    mine, ref = as_double(F.col("common")), F.col("ref_common")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    far = materialize(far.select(
        *base, "lang", F.when(F.col("chars") >= MIN_JUDGED_CHARS, js_distance(as_double(F.col("classes")), F.col("ref_classes"))).alias("char_distance"),
        F.when(F.col("n_words") >= MIN_JUDGED_WORDS, js_distance(share(mine), share(ref))).alias("share_distance"),
        F.when((F.col("n_words") >= MIN_JUDGED_WORDS) & (total(listed(mine)) >= MIN_JUDGED_COMMON), js_distance(listed(mine), listed(ref))).alias("word_distance"),
        *carry), "quality-distances")
    far = join_language(far, limits(far), "limit_lang")
    kept = ~F.col("base_failed")
    for kind, (_, _, otherwise) in LIMITS.items():
        kept &= F.coalesce(steps(F.col(f"{kind}_distance")) <= F.coalesce(F.col(f"{kind}_limit"), F.lit(otherwise)), F.lit(True))
    return far.select(*base, kept.alias("kept"), *[f"{kind}_distance" for kind in LIMITS], *carry)
