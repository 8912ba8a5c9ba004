"""The registered queries of this subpackage: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickpath.llm.decontaminate import contaminated
from clickpath.llm.hmm import score_documents
from clickpath.llm.licences import find_licences
from clickpath.llm.linededup import line_digests
from clickpath.llm.mixture import mix_sources
from clickpath.llm.neardup import near_duplicate_groups
from clickpath.llm.oracle import ORACLE_SQL  # noqa: F401  (registered with QUERIES)
from clickpath.llm.preference import preference_examples
from clickpath.llm.quality import judge_quality
from clickpath.llm.ranking import rank_documents
from clickpath.llm.reshard import reshard
from clickpath.llm.secrets import scan_secrets
from clickpath.llm.substrings import repeated_words
from clickpath.llm.trie import conversation_trie

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"))


def op2_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reshard(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op3_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix_sources(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"))


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep_idioms=True)


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(_table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(_table(spark, sf_dir, "documents"))


def op8_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_examples(_table(spark, sf_dir, "conversations"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op11_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_quality_rules, op2_flow_reshard, op3_budget_mix, op4_template_decontamination, op5_licence_scan,
              op6_near_duplicates, op7_line_dedup, op8_hmm_scores, op9_preference_pairs, op10_secret_scan,
              op11_recompression_dedup, op12_conversation_trie, op13_ranked_search)
}
