"""The registered queries of this folder, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtrail.llm.decontamination import contamination_digest
from loadtrail.llm.exact_dedup import exact_duplicates
from loadtrail.llm.hard_negatives import hard_negatives
from loadtrail.llm.html_text import extracted
from loadtrail.llm.lm_scoring import text_scores
from loadtrail.llm.ngram_join import similar_components
from loadtrail.llm.packing import packed
from loadtrail.llm.pii import personal_data
from loadtrail.llm.prefix_trie import prefix_nodes
from loadtrail.llm.quality import quality_verdicts
from loadtrail.llm.sentencepiece_viterbi import round_trips
from loadtrail.llm.sharding import sharded
from loadtrail.llm.substring_dedup import without_repeated_spans


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_components(table(spark, folder, "documents"), words=3, percent=90, count_links=True)


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"), keep="largest")


def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return text_scores(table(spark, folder, "documents"))


def sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    found = round_trips(table(spark, folder, "documents"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "decoded_sha256", "round_trip")


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharded(table(spark, folder, "documents"))


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(table(spark, folder, "documents"))


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def personal(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeated_spans(table(spark, folder, "documents"), run_words=40)


def prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_nodes(table(spark, folder, "conversations"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination_digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def hard_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": ngram_join,
        "op2_exact_dedup": exact_dedup,
        "op3_lm_scoring": lm_scoring,
        "op4_sentencepiece": sentencepiece,
        "op5_sharding": sharding,
        "op6_html_extraction": html_extraction,
        "op7_quality_rules": quality_rules,
        "op8_packing": packing,
        "op9_pii": personal,
        "op10_substring_dedup": substring_dedup,
        "op11_prefix_trie": prefix_trie,
        "op12_decontamination": decontamination,
        "op13_hard_negatives": hard_negative_mining,
    }
