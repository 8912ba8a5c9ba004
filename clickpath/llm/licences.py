"""Licence scan: a trained paragraph classifier over sparse word n-grams (native columns only).

A multinomial logistic regression over one- and two-word features is fitted on
labelled paragraphs (:mod:`clickpath.llm.wordings`): names of each family in
the frames of a notice, its notice text whole, by sentence, cut as pages wrap
it and with words dropped, names outside the families (class ``other``), and
for class ``none`` ordinary sentences with words of notices and a bounded
sample of corpus paragraphs without any of ``NOTICE_WORDS`` that do not read
like a notice text.
Every line of every document is scored, so a wrapped notice shows line by
line.  Probabilities are calibrated by a temperature chosen on held-out rows,
and the least probability that names a family by how often held-out rows of no
family reach it.  A licence paragraph below it, or whose words do not resemble
the family's names or notice, is reported as ``unknown`` if it holds one of
``NOTICE_WORDS``, else not at all.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, functions as F

from clickpath.llm.columns import let, words
from clickpath.llm.storage import materialize
from clickpath.llm.wordings import CLASSES, FAMILIES, NONE, NOTICE_WORDS, OTHER, PUNCTUATION, labelled_wordings, notice_pairs, reference_words

SAMPLE_DOCS = 500
SAMPLE_ROWS = 2000
MAX_FEATURES = 4096
PENALTY = 0.0001
MIN_TEMPLATE_PCT = 60
MIN_NOTICE_WORDS = 5
MAX_OPEN_PCT = 2
SEED = 20240229


def plain_words(text: Column) -> Column:
    """Lower-case words, punctuation at their ends dropped."""
    bare = F.transform(words(F.lower(text)), lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    return F.array_remove(bare, "")


def pair_features(tokens: Column) -> Column:
    """Every word and every two neighbouring words."""
    pairs = F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(tokens, i + 1)))
    return F.concat(tokens, pairs)


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, tokens): the lines that hold a word, numbered from 0 by line."""
    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("paragraph"), plain_words(line).alias("tokens")))
    # a generator, so that no later filter is computed on words that are split anew for every use
    return docs.select("doc_id", F.inline(F.filter(numbered, lambda p: F.size(p["tokens"]) > 0)))


class Model:
    """Weights by class of the features that have any, intercepts, temperature and the least probability of a named family."""

    def __init__(self, features: list[str], weights: list[list[float]], intercepts: list[float], temperature: float, cut: float):
        self.features, self.weights, self.intercepts, self.temperature, self.cut = features, weights, intercepts, temperature, cut


def training_rows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(y, features, worded, held): the labelled wordings, and at most ``sample_rows`` ordinary paragraphs of ``sample_docs`` documents."""
    spark = docs.sparkSession
    wordings = spark.createDataFrame(labelled_wordings(), "label string, text string")
    wordings = wordings.select("label", plain_words(F.col("text")).alias("tokens"), F.lit(True).alias("worded"))
    # the documents with the smallest hashes; a bound on the hash first, so that each task sends few rows to the sort
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 40))
    bound = int(min(1.0, 4 * sample_docs / max(1, docs.count())) * (1 << 40))
    drawn = docs.where("text is not null").where(draw <= bound).orderBy(draw, "doc_id").limit(sample_docs)
    notices = sorted({pair for *_, text in FAMILIES.values() for pair in notice_pairs(text)})
    ordinary = (paragraphs(drawn).where(~F.arrays_overlap("tokens", F.lit(list(NOTICE_WORDS))))
                .where(inside(F.col("tokens"), notices) < MIN_TEMPLATE_PCT)
                .orderBy(F.xxhash64(F.lit(SEED), "tokens"), "doc_id", "paragraph").limit(sample_rows)
                .select(F.lit(NONE).alias("label"), F.slice("tokens", 1, 60).alias("tokens"), F.lit(False).alias("worded")))
    return materialize(wordings.unionByName(ordinary).select(
        (F.array_position(F.lit(list(CLASSES)), F.col("label")) - 1).cast("double").alias("y"),
        pair_features(F.col("tokens")).alias("features"), "worded", (F.pmod(F.xxhash64("tokens"), F.lit(4)) == 0).alias("held")).coalesce(2), "licence-rows")


def fit(docs: DataFrame) -> Model:
    """L1 logistic regression on three quarters of the labelled rows, temperature and cut on the rest."""
    rows = training_rows(docs)
    vocabulary = CountVectorizer(inputCol="features", outputCol="x", vocabSize=MAX_FEATURES, binary=True).fit(rows.where("worded"))
    data = vocabulary.transform(rows)
    trained = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", regParam=PENALTY, elasticNetParam=1.0,
                                 standardization=False, maxIter=100).fit(data.where("not held"))
    matrix, bias = trained.coefficientMatrix.toArray(), trained.interceptVector.toArray()
    used = [i for i in range(matrix.shape[1]) if abs(matrix[:, i]).max() > 0]
    # at most SAMPLE_ROWS rows and the wordings
    held = [(int(r.y), (bias + sum((matrix[:, i] for i in r.x.indices), 0 * bias)).tolist())
            for r in data.where("held").select("y", "x").collect()]
    temperature = calibrate(held)
    return Model([vocabulary.vocabulary[i] for i in used], matrix[:, used].tolist(), bias.tolist(), temperature, open_set_cut(held, temperature))


def calibrate(held: list[tuple[int, list[float]]]) -> float:
    """The temperature with the least held-out log loss, from a fixed grid."""
    def loss(t: float) -> float:
        out = 0.0
        for y, logits in held:
            top = max(logits)
            out += math.log(sum(math.exp((v - top) / t) for v in logits)) - (logits[y] - top) / t
        return out

    return min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)


def open_set_cut(held: list[tuple[int, list[float]]], temperature: float) -> float:
    """The least of a grid of probabilities that at most ``MAX_OPEN_PCT`` percent of the held-out rows of no family reach in one."""
    first = CLASSES.index(OTHER) + 1
    reached = []
    for y, logits in held:
        if y < first:
            top = max(logits)
            reached.append(max(math.exp((v - top) / temperature) for v in logits[first:])
                           / sum(math.exp((v - top) / temperature) for v in logits))
    grid = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9)
    return next((p for p in grid if 100 * sum(r >= p for r in reached) <= MAX_OPEN_PCT * len(reached)), grid[-1])


def inside(tokens: Column, pairs: list[str]) -> Column:
    """Percent of the paragraph's neighbouring word pairs that are among ``pairs`` (0 for short paragraphs)."""
    mine = F.array_distinct(F.transform(F.slice(tokens, 2, F.size(tokens)), lambda w, i: F.concat(F.get(tokens, i), F.lit(" "), w)))
    return F.when(F.size(tokens) >= MIN_NOTICE_WORDS, 100.0 * F.size(F.array_intersect(mine, F.lit(pairs))) / F.size(mine)).otherwise(0.0)


def template_share(tokens: Column, family: Column) -> Column:
    """How well the paragraph fits the family's texts, in percent.

    The larger of the share of a name's or the notice's words that the
    paragraph holds and, from ``MIN_NOTICE_WORDS`` words on, the share of the
    paragraph's neighbouring word pairs that stand in the notice.
    """
    def share(text: list[str]) -> Column:
        return 100.0 * F.size(F.array_intersect(tokens, F.lit(text))) / len(set(text))

    out = F.lit(0.0)
    for name in FAMILIES:
        best = F.array_max(F.array(*[share(text) for text in reference_words(name)], inside(tokens, notice_pairs(FAMILIES[name][-1]))))
        out = F.when(family == name, best).otherwise(out)
    return out


def find_licences(docs: DataFrame) -> DataFrame:
    """One row per licence paragraph: doc_id, paragraph, family, predicted, probability, template_pct.

    ``family`` is the predicted one where it is probable enough and the
    template confirms it, else ``unknown`` (with a notice word only).
    Paragraphs are lines, numbered from 0, of any length.  Null and empty texts hold none, rows without an id keep a null
    one, repeated rows are reported each, and an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs)
    rows = feature_hits(docs, model.features)
    logits = F.array(*[F.aggregate("at", F.lit(b), partial(_add_weight, F.lit(w))) / model.temperature
                       for w, b in zip(model.weights, model.intercepts)])
    rows = rows.select("doc_id", "paragraph", "tokens", let(logits, verdict).alias("v")).where(F.col("v.predicted") != NONE)
    rows = materialize(rows.select("doc_id", "paragraph", "tokens", "v.*"), "licence-hits")
    spelt = F.transform("tokens", lambda w: F.replace(w, F.lit("licence"), F.lit("license")))
    rows = rows.withColumn("template_pct", template_share(spelt, F.col("predicted")))
    sure = ((F.col("predicted") != OTHER) & (F.col("probability") >= model.cut) & (F.col("template_pct") >= MIN_TEMPLATE_PCT))
    rows = rows.where(sure | F.arrays_overlap("tokens", F.lit(list(NOTICE_WORDS))))
    return rows.select("doc_id", F.col("paragraph").cast("int").alias("paragraph"), F.when(sure, F.col("predicted")).otherwise("unknown").alias("family"),
                       "predicted", "probability", F.round("template_pct", 6).alias("template_pct"))


def feature_hits(docs: DataFrame, features: list[str]) -> DataFrame:
    """(doc_id, paragraph, tokens, at): the lines with a weighted feature, and which features they hold.

    Without one only the intercepts speak, and they say none.  Two neighbouring
    words are put together only where the first one begins a weighted pair.
    """
    pairs = [f for f in features if " " in f]
    begin = sorted({f.split(" ")[0] for f in pairs})
    single = [f for f in features if " " not in f]

    def known(tokens: Column) -> Column:
        pair = F.transform(tokens, lambda w, i: F.when(w.isin(*begin), F.concat(w, F.lit(" "), F.get(tokens, i + 1))))
        return F.array_distinct(F.concat(F.filter(tokens, lambda w: w.isin(*single)), F.filter(pair, lambda f: f.isin(*pairs))))

    def of_line(line: Column, i: Column) -> Column:
        at = lambda tokens: F.transform(known(tokens), lambda f: (F.array_position(F.lit(features), f) - 1).cast("int"))
        return let(plain_words(line), lambda tokens: F.struct(i.alias("paragraph"), tokens.alias("tokens"), at(tokens).alias("at")))

    lines = F.transform(F.split("text", "\n"), of_line)
    return docs.select("doc_id", F.inline(F.filter(lines, lambda x: F.size(x["at"]) > 0)))


def verdict(logits: Column) -> Column:
    """(predicted, probability): the likeliest class and its calibrated probability."""
    return let(F.array_max(logits), lambda top: F.struct(
        F.element_at(F.lit(list(CLASSES)), F.array_position(logits, top).cast("int")).alias("predicted"),
        F.round(1 / F.aggregate(logits, F.lit(0.0), lambda a, v: a + F.exp(v - top)), 6).alias("probability")))


def _add_weight(weights: Column, acc: Column, i: Column) -> Column:
    return acc + F.get(weights, i)
