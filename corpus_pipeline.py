"""Corpus pipeline: stages over ``documents``, each stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltseries.llm.language_id import accepted_documents
from voltseries.llm.mixing import mixed_documents
from voltseries.llm.ngram_join import one_per_component
from voltseries.llm.packing import pack
from voltseries.llm.pii import pseudonymise
from voltseries.session import scratch_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return accepted_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates."""
    return one_per_component(docs)


def pseudonymise_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal values."""
    return pseudonymise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources draw them."""
    return mixed_documents(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in batches of their length bucket."""
    return pack(docs)


STAGES = [
    ("language_id", identify_languages),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("pii", pseudonymise_persons),
    ("source_mixing", mix_sources),
    ("packing", pack_batches),
]

# SQL cannot express the fitted language model, the keyed permutations and the draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
