"""One query op<N>_<name> for each operator, over the whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinfold.llm import oracles
from twinfold.llm.common import table
from twinfold.llm.conversation_repair import conversation_repair
from twinfold.llm.decontamination import scan
from twinfold.llm.digests import damaged, run_digests, with_repeats
from twinfold.llm.jaccard_join import jaccard_components
from twinfold.llm.mixture import mixed_documents, mixture
from twinfold.llm.pattern_packing import pattern_packing
from twinfold.llm.periodic_runs import periodic_runs
from twinfold.llm.pii import pii_spans
from twinfold.llm.quality_rules import quality_rules
from twinfold.llm.secret_scan import secret_scan
from twinfold.llm.substring_dedup import substring_dedup
from twinfold.llm.token_counts import token_counts
from twinfold.llm.token_output import token_output
from twinfold.llm.tokens import default_path
from twinfold.llm.toxicity import toxicity


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules(table(spark, sf_dir, "documents")).select(kept)


def op3_frame_of_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), default_path()).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op8_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing(table(spark, sf_dir, "documents"), default_path())


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.tiktoken"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair(damaged(conversations), conversations)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_repeats(table(spark, sf_dir, "documents"))))


def op13_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(mixture(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


_ALL = (
    op1_decontamination,
    op2_quality_rules,
    op3_frame_of_reference,
    op4_substring_dedup,
    op5_pii,
    op6_jaccard_join,
    op7_secret_scan,
    op8_pattern_packing,
    op9_token_counts,
    op10_toxicity,
    op11_conversation_repair,
    op12_periodic_runs,
    op13_source_mixture,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

#: The other operators learn, tokenize or pack: their tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": oracles.DECONTAMINATION,
    "op2_quality_rules": oracles.QUALITY_RULES,
    "op4_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op6_jaccard_join": oracles.JACCARD_JOIN,
    "op7_secret_scan": oracles.SECRET_SCAN,
    "op11_conversation_repair": oracles.CONVERSATION_REPAIR,
    "op12_periodic_runs": oracles.PERIODIC_RUNS,
}
