"""A training corpus from raw documents: each stage works on all that its predecessor kept.

Every stage is written as Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadtrail.llm.exact_dedup import drop_exact_duplicates
from loadtrail.llm.ngram_join import drop_similar
from loadtrail.llm.packing import packed
from loadtrail.llm.pii import sanitised
from loadtrail.llm.quality import drop_low_quality
from loadtrail.llm.staging import landed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules take for good."""
    return drop_low_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the one with the smallest identifier."""
    return drop_exact_duplicates(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words with a similarity of 0.8 or more."""
    return drop_similar(docs, words=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data generalised in the text."""
    return sanitised(docs, length_column="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("pii", pii),
    ("packing", packing),
]

#: The votes are weighed by expectation-maximisation and the packing is a search over sums: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
