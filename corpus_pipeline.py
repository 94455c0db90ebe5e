"""A corpus pipeline of five stages over `documents`, each on all that the one before kept.

run(spark, sf_dir) applies them in order; each stage's result is written as Parquet to the shared folder and read
again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinfold.llm.common import table, written
from twinfold.llm.decontamination import decontaminate
from twinfold.llm.jaccard_join import near_unique
from twinfold.llm.pattern_packing import pattern_packing
from twinfold.llm.pii import mask_pii
from twinfold.llm.tokens import default_path
from twinfold.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return near_unique(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are words of benchmark windows go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; n_chars follows."""
    return mask_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document: its sequence and place there."""
    return pattern_packing(docs, default_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# Learned models, a tokenizer and a packing plan: no SQL expresses these rows, so tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
