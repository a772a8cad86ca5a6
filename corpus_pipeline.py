"""From raw documents to token files: five stages, each a written table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodtide.llm import decontaminate, language, mixing, near_duplicates, token_files
from moodtide.llm.queries import table, tokenizer_json
from moodtide.storage import store


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is none of ours or not sure enough."""
    return language.accepted_documents(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return near_duplicates.one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files; one row per document as read back from them."""
    return token_files.token_files(spark, docs.select("doc_id", "text"), tokenizer_json())


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", tokens),
]

# Learnt models, samples, iterations and token files are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
