"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

language ID -> exact dedup -> n-gram Jaccard join -> benchmark decontamination -> BPE encoding and decoding

Every stage takes all rows its predecessor kept and returns the columns of ``documents``; the last returns one row per
document that is left with its token count and digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelcast.llm import bpe_backtrack, chunk_dedup, jaccard_join, language_evidence, positional_index
from reelcast.llm.common import stage_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not identified go."""
    return language_evidence.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space the longest original stays."""
    return chunk_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return positional_index.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what is left."""
    return bpe_backtrack.digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]

# byte pair merges have no SQL form; tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir))
    return docs
