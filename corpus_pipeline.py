"""A corpus pipeline of five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faremill.llm.common import small_batches, stored
from faremill.llm.fm_decontaminate import remove_contamination
from faremill.llm.host_rules import keep_good
from faremill.llm.near_duplicates import keep_first
from faremill.llm.queries import piece_digests
from faremill.llm.secret_scan import redact_secrets


#: Words whose ids a worker keeps; fewer than alone, as workers have served four other stages by then.
KEPT_WORDS = 60_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail their own rules or come from a rejected host go."""
    small_batches(spark)
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    small_batches(spark)
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside windows of the benchmark go; documents that have no others go too."""
    small_batches(spark)
    return remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that look live are replaced by a mark."""
    small_batches(spark)
    return redact_secrets(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of the ids and of the text they decode to."""
    small_batches(spark, 1 << 20)
    return piece_digests(docs, KEPT_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("tokenize", tokenize),
]

#: SQL cannot express the encoding; ``tests/llm/test_pipeline.py`` compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
