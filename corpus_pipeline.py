"""A training corpus from raw documents: quality rules, near duplicates, benchmark passages, personal data, source mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import decontaminate, jaccard, mixing, pii, quality
from weirflow.llm.common import written
from weirflow.session import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the language-model ratio reject go."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays."""
    prepare(spark)
    return jaccard.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any benchmark window go."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away are replaced; n_chars follows the text."""
    prepare(spark)
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target, dealt to shuffled shards: one row per copy taken."""
    prepare(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("PII", hide_personal_data),
    ("mixing sources to target weights", mix_sources),
]

ORACLE_SQL = None  # hashed log ratios and the dealt draw have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and reread."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
