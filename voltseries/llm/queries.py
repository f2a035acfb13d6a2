"""The registered queries of the operators; tables are read from ``folder``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltseries.llm import (
    chat_format,
    collision_ann,
    collocations,
    fingerprint,
    hard_negatives,
    language_id,
    license_scan,
    minhash_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    url_filter,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_classes(_table(spark, folder, "documents"))


def op2_length_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, folder, "documents"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify_documents(_table(spark, folder, "documents"))


def page_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The same operator where markup and addresses are at hand."""
    return language_id.identify_pages(_table(spark, folder, "pages"))


def op5_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprint_pairs(_table(spark, folder, "documents"))


def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op7_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymise(_table(spark, folder, "documents").select("doc_id", "text"), count=True)


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"))


def op9_collision_ann(spark: SparkSession, folder: str) -> DataFrame:
    return collision_ann.nearest(_table(spark, folder, "embeddings"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    # Conversation -7 of the contract: control strings inside the texts.
    tricky = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(chat_format.training_examples(turns.unionByName(added)))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op12_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_length_packing": op2_length_packing,
        "op3_license_scan": op3_license_scan,
        "op4_language_id": op4_language_id,
        "page_language_id": page_language_id,
        "op5_fingerprint": op5_fingerprint,
        "op6_source_mixing": op6_source_mixing,
        "op7_pii_pseudonyms": op7_pii_pseudonyms,
        "op8_url_filter": op8_url_filter,
        "op9_collision_ann": op9_collision_ann,
        "op10_chat_format": op10_chat_format,
        "op11_collocations": op11_collocations,
        "op12_minhash_dedup": op12_minhash_dedup,
        "op13_hard_negatives": op13_hard_negatives,
    }
