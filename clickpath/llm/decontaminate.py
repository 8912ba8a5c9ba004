"""Benchmark decontamination by template canonicalisation (native columns only).

Numbers, names and units become typed placeholders, so a benchmark question
whose values were changed keeps its template.  Windows of ``WINDOW``
canonical tokens of the documents meet those of the benchmark in a hash join.
The matches of a document and an item on one diagonal (the same shift between
their positions) make a passage; it counts if it is long enough and its slots
are consistent: one value of the item must stand for one value of the
document wherever it occurs.

Beside them go literal windows: the same words with case folded and no slots
(items under ``WINDOW`` words: the whole item), so that a copy is found
whatever its case, and whatever share of its words are names or numbers.  A
short item without a template window of enough literal words is one whole
template of two literal words at least; a caller may leave out those that so
many documents hold that they may be idioms, not copies.  A
literal passage counts by the same lengths, unless it is a part of the item
and the template passage on its diagonal is inconsistent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickpath.llm.columns import let
from clickpath.llm.storage import materialize

WINDOW = 8
MIN_LITERALS = 5
MIN_WINDOWS = 3
MIN_SHARE_PCT = 10
BROADCAST_ROWS = 1_000_000
# Whole templates of short items: fewest literal words; more documents than this, and than one in so many, make it an idiom
MIN_SHORT_LITERALS = 2
COMMON_DOCS = 20
COMMON_SHARE = 1_000

# Punctuation that is dropped before words are compared
PUNCTUATION = ".,;:!?\"'()[]{}<>«»“”„‘’…`*_|"

# White space beside the blank
BREAKS = "\t\n\x0b\x0c\r"

# Unit words
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "meter", "meters",
    "metre", "metres", "kilometer", "kilometers", "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ounce",
    "ounces", "pound", "pounds", "ton", "tons", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
    "year", "years", "percent", "%", "dollar", "dollars", "euro", "euros", "cent", "cents", "mph", "kmh", "km/h",
    "celsius", "fahrenheit", "degrees", "watt", "watts", "volt", "volts", "joule", "joules",
)

# Signs and currencies before a number
SIGNS = ("+", "-", "$", "€", "£")

TEMPLATE = 0  # kind of a window; literal windows have their number of words, whole templates of short items its negative

NUMBER, UNIT, NAME = "<num>", "<unit>", "<name>"


def bare_words(text: Column) -> Column:
    """Words without punctuation, as written (one pass maps white space to blanks and drops punctuation)."""
    plain = F.translate(F.coalesce(text, F.lit("")), BREAKS + PUNCTUATION, " " * len(BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def canonical(word: Column) -> Column:
    """A typed placeholder for a number, a unit or a capitalised word; else the word in lower case."""
    low = F.lower(word)
    first = F.substring(word, 1, 1)
    ordinary = (word == low) & (first >= "a") & ~word.isin(*UNITS)  # most words: answered first
    return (F.when(ordinary, word).when(first.between("0", "9") | (first.isin(*SIGNS) & F.rlike(word, F.lit(r"^[+$€£-]+[0-9]"))), NUMBER)
            .when(low.isin(*UNITS), UNIT)
            .when(~F.startswith(low, first), NAME)
            .otherwise(low))


def is_slot(token: Column) -> Column:
    return token.isin(NUMBER, UNIT, NAME)


def with_token_hashes(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``words``) and their ``template`` and ``literal`` tokens, each hashed once.

    A literal token is the word with case folded, hashed apart from the template tokens.
    """
    return rows.withColumn("template", F.transform("words", lambda w: F.xxhash64(canonical(w)))).withColumn(
        "literal", F.transform("words", lambda w: F.xxhash64(F.lower(w), F.lit("folded"))))


def window_of(tokens: Column, size: int) -> Column:
    """64-bit hash of every ``size``-token window (shorter arrays: none), from two windows of a power of two that cover it.

    ``tokens``: a plain column.  Each level is computed once (:func:`let`).
    """
    if size == 1:
        return tokens
    part = 1 << ((size - 1).bit_length() - 1)
    n = F.greatest(F.size(tokens) - (size - 1), F.lit(0))
    return let(window_of(tokens, part), lambda h: F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(size - part + 1), n), lambda x, y: F.xxhash64(x, y)))


def window_size(kind: Column) -> Column:
    return F.when(kind == TEMPLATE, F.lit(WINDOW)).otherwise(F.abs(kind))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(hash, kind, item_id, item_pos): the template windows of every item that hold enough literal words, its literal windows,
    and the whole template of short items without such a window."""
    rows = with_token_hashes(benchmark.select(F.col("item_id").cast("long").alias("item_id"), bare_words(F.col("text")).alias("words"))
                             .withColumn("slot", F.transform("words", lambda w: is_slot(canonical(w))))
                             .withColumn("row", F.monotonically_increasing_id()))
    rows = materialize(rows, "benchmark-tokens")
    template = rows.select("row", "item_id", "slot", F.posexplode(window_of(F.col("template"), WINDOW)).alias("item_pos", "hash"))
    literals = lambda slots: F.size(F.filter(slots, lambda x: ~x))
    template = template.where(literals(F.slice("slot", F.col("item_pos") + 1, WINDOW)) >= MIN_LITERALS)
    out = template.select("hash", F.lit(TEMPLATE).alias("kind"), "item_id", "item_pos")
    for size in range(1, WINDOW + 1):
        own = rows if size == WINDOW else rows.where(F.size("literal") == size)
        out = out.unionByName(own.select("item_id", F.lit(size).alias("kind"), F.posexplode(window_of(F.col("literal"), size)).alias("item_pos", "hash")))
    short = (rows.join(template.select("row").distinct(), "row", "left_anti")
             .where((literals(F.col("slot")) >= MIN_SHORT_LITERALS) & (literals(F.col("slot")) < F.size("slot"))))
    for size in range(MIN_SHORT_LITERALS + 1, 2 * WINDOW):
        out = out.unionByName(short.where(F.size("slot") == size).select(
            "item_id", F.lit(-size).alias("kind"), F.posexplode(window_of(F.col("template"), size)).alias("item_pos", "hash")))
    return out


def document_windows(docs: DataFrame, key: list[str], kinds: list[int]) -> DataFrame:
    """(*key, n_words, place, hash): every window of these kinds of every document; ``place`` counts through the kinds in order."""
    rows = with_token_hashes(docs.select(*key, bare_words(F.col("text")).alias("words"))).select(*key, "template", "literal")
    hashes = [window_of(F.col("literal" if k > 0 else "template"), abs(k) or WINDOW) for k in kinds]
    return rows.select(*key, F.size("literal").alias("n_words"), F.posexplode(F.concat(*hashes)).alias("place", "hash"))


def document_position(kinds: list[int]) -> Column:
    """First word of a document window, from its kind, its place and the document's word count; null where the place is of another kind."""
    out, before = F.lit(None).cast("int"), F.lit(0)
    for k in kinds:
        at, n = F.col("place") - before, F.greatest(F.col("n_words") - ((abs(k) or WINDOW) - 1), F.lit(0))
        out = F.when((F.col("kind") == k) & (at >= 0) & (at < n), at).otherwise(out)
        before = before + n
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, key: tuple[str, ...] = ("doc_id",), keep_idioms: bool = False) -> DataFrame:
    """One row per (document, item) found: doc_id, item_id, n_windows, item_windows, n_slots, n_changed.

    ``n_windows`` counts the matched windows of the best passage, ``n_changed``
    its slots whose value differs from the item's (none in a literal passage).
    Null and empty texts match nothing, rows without an id cannot be named and
    are left out, repeated rows count once, and an empty table on either side
    gives no rows.  ``key``: the columns that name a document, instead of its id.
    ``keep_idioms``: whole templates of short items count however many documents
    hold them; without it, those over ``COMMON_DOCS`` and one in ``COMMON_SHARE``
    documents do not.  Literal copies count either way.
    """
    key = list(key)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).select(*key, "text").dropna(subset=[*key, "text"])
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    item_windows = materialize(benchmark_windows(benchmark).distinct(), "benchmark-windows")
    # one row per kind, at most 24
    kinds = sorted(r[0] for r in item_windows.select("kind").distinct().collect()) or [TEMPLATE]
    # checked size; a larger benchmark joins by shuffle
    beside = F.broadcast if item_windows.count() <= BROADCAST_ROWS else lambda rows: rows
    place = [*key, "item_id", "shift"]
    found = (document_windows(docs, key, kinds).join(beside(item_windows), "hash").withColumn("doc_pos", document_position(kinds)).where("doc_pos is not null")
             .groupBy(*key, "item_id", (F.col("doc_pos") - F.col("item_pos")).alias("shift"), "kind")
             .agg(F.sort_array(F.collect_set("item_pos")).alias("at")))
    matches = found
    if kinds[0] < TEMPLATE and not keep_idioms:  # a short template that many documents hold is an idiom, not a copy
        found = materialize(found, "matches")
        limit = F.lit(max(COMMON_DOCS, docs.count() // COMMON_SHARE))
        idioms = (found.where(F.col("kind") < TEMPLATE).select("item_id", "kind", *key).distinct().groupBy("item_id", "kind")
                  .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit))
        matches = found.join(idioms, ["item_id", "kind"], "left_anti")
    per_item = item_windows.groupBy("item_id", "kind").agg(F.count_distinct("item_pos").alias("item_windows"))
    passages = materialize(
        matches.join(beside(per_item), ["item_id", "kind"]).withColumn("n_windows", F.size("at"))
        .where((F.col("n_windows") >= F.least(F.lit(MIN_WINDOWS), F.col("item_windows")))
               & (100 * F.col("n_windows") >= MIN_SHARE_PCT * F.col("item_windows"))), "passages")

    # slots: the words of both sides at the placeholder positions that matched windows cover
    item_words = benchmark.dropDuplicates(["item_id", "text"]).select("item_id", bare_words(F.col("text")).alias("item_words"))
    named = passages.select(*key).distinct()
    doc_words = (docs.join(named, key, "left_semi").dropDuplicates([*key, "text"])
                 .select(*key, bare_words(F.col("text")).alias("doc_words")))
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + (window_size(F.col("kind")) - 1)))))
    both = (passages.join(beside(item_words), "item_id").join(doc_words, key).withColumn("covered", covered)
            .withColumn("slots", F.filter("covered", lambda p: is_slot(canonical(F.get(F.col("item_words"), p)))))
            .withColumn("pairs", F.transform("slots", lambda p: F.struct(
                F.get(F.col("item_words"), p).alias("item"), F.get(F.col("doc_words"), (p + F.col("shift")).cast("int")).alias("doc")))))
    consistent = F.size(F.array_distinct("pairs")) == F.size(F.array_distinct(F.transform("pairs", lambda s: s["item"])))
    both = both.select(
        *place, "kind", (F.col("kind") <= TEMPLATE).alias("template"), "n_windows", "item_windows", consistent.alias("consistent"),
        F.size("pairs").cast("long").alias("n_slots"), F.size(F.filter("pairs", lambda s: ~s["item"].eqNullSafe(s["doc"]))).cast("long").alias("changed"))
    best = F.struct(F.col("n_windows").cast("long").alias("n_windows"), "n_slots",
                    F.when(F.col("template"), -F.col("changed")).otherwise(F.lit(0)).cast("long").alias("kept_slots"), "item_windows")
    # a diagonal: its literal passage counts if it is the whole item or no template passage contradicts
    ok_template = F.max(F.when(F.col("template") & F.col("consistent"), best))
    contradicted = F.coalesce(F.max(F.col("template") & ~F.col("consistent")), F.lit(False))
    whole = F.max(F.when(~F.col("template") & (F.col("n_windows") == F.col("item_windows")), best))
    literal = F.max(F.when(~F.col("template"), best))
    found = (both.groupBy(*place).agg(ok_template.alias("t"), contradicted.alias("no"), whole.alias("w"), literal.alias("l"))
             .select(*key, "item_id", F.greatest("t", "w", F.when(~F.col("no"), F.col("l"))).alias("best")).where("best is not null"))
    return (found.groupBy(*key, "item_id").agg(F.max("best").alias("b"))
            .select(*key, "item_id", F.col("b.n_windows").alias("n_windows"), F.col("b.item_windows").alias("item_windows"),
                    F.col("b.n_slots").alias("n_slots"), (-F.col("b.kept_slots")).alias("n_changed")))
