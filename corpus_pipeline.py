"""A training corpus from ``documents`` in five stages, each one operator on all its predecessor kept.

Every stage but the last returns the columns of ``documents``; n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import line_dedup, ngram_join, packing, pii, quality, staging


def _counted(documents: DataFrame) -> DataFrame:
    return documents.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return quality.kept_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents of which nothing but blanks is left."""
    cut = line_dedup.remove_repeated_lines(docs)
    return _counted(cut.filter("n_removed < n_lines OR n_lines = 0").select(docs.columns))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest doc_id. Rows without a doc_id stay."""
    return ngram_join.without_near_copies(docs)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced."""
    return _counted(pii.replace_pii(docs, pii.application_key(spark)).select(docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token windows."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard", ngram_jaccard),
    ("pii_surrogates", pii_surrogates),
    ("packing", pack_windows),
]

#: Rolling hashes, set similarity and tokens aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
