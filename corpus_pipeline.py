"""Corpus pipeline over ``documents``: quality rules, near-duplicates, decontamination, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a frame that the runner
writes as Parquet and reads back as the next stage's ``docs``; all but the
last return the columns of ``documents``.  Decisions find their row by a digest
of all its columns, not by its id, so rows without an id and different rows
under one id are kept or rejected on their own.  Repeated rows leave the near-duplicate stage once; the mix repeats rows on
purpose, and the shards hold each repeat.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickpath.llm.columns import row_digest
from clickpath.llm.decontaminate import contaminated
from clickpath.llm.mixture import mix_sources
from clickpath.llm.neardup import near_duplicate_groups
from clickpath.llm.quality import judge_quality
from clickpath.llm.reshard import reshard
from clickpath.llm.storage import materialize


NEAR_PCT = 80


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until ``docs`` has no column of that name."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def named(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with the digests of its rows, and the names of these two columns."""
    names = fresh(docs, "pipeline_digest_a", "pipeline_digest_b")
    return docs.select("*", *[d.alias(name) for d, name in zip(row_digest(docs), names)]), names


def own(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows, digests = named(docs)
    kept = judge_quality(rows.select("doc_id", "text", "lang", *digests), digests).where("kept").select(digests).distinct()
    return rows.join(kept, digests, "left_semi").select(own(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of texts at a similarity of 0.8 or more (one without an id if none has one)."""
    rows, digests = named(docs)
    number, = fresh(rows, "pipeline_row")
    rows = materialize(rows.withColumn(number, F.monotonically_increasing_id()), "near-rows")
    ids = rows.select(F.col(number).alias("row"), "doc_id", *[F.col(d).alias(x) for d, x in zip(digests, "ab")])
    groups = near_duplicate_groups(rows.select(F.col(number).alias("doc_id"), "text"), NEAR_PCT).withColumnRenamed("doc_id", "row")
    # texts without words stand alone, but repeated rows leave once
    alone = F.col("n_shingles") == 0
    of = [F.when(~alone, F.col("component_id")).alias("group"), *[F.when(alone, F.col(x)).alias(f"alone_{x}") for x in "ab"]]
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b", "row")).alias("first")
    kept = groups.join(ids, "row").groupBy(*of).agg(first).select(F.col("first.row").alias(number))
    return rows.join(kept, number, "left_semi").select(own(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of any benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows, digests = named(docs)
    found = contaminated(rows.select("doc_id", "text", *digests), benchmark, digests, keep_idioms=True).select(digests).distinct()
    return rows.join(found, digests, "left_anti").select(own(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows, digests = named(docs)
    times, = fresh(rows, "pipeline_times")
    taken = (mix_sources(rows.select("doc_id", "text", "source", *digests), carry=digests).where("repeats > 0")
             .groupBy(digests).agg(F.sum("repeats").alias(times)))
    return (rows.join(taken, digests).dropDuplicates(digests).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(own(docs)))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    return reshard(docs.select("doc_id", "text")).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

# The seeded draws of the mix and the blocks of the shards follow Spark's hash, which SQL elsewhere does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
