"""The corpus pipeline: five operators over ``documents``, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from townsquare.llm import decontamination, line_rules, mixture, near_duplicates, private_data
from townsquare.llm.common import Stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rejected documents; kept ones lose their frequent lines."""
    with Stored(spark) as stored:
        return line_rules.clean(docs, stored)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    with Stored(spark) as stored:
        return near_duplicates.one_of_each(docs, stored)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark items."""
    with Stored(spark) as stored:
        return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), stored)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in place."""
    return private_data.redact(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the mix takes; ``mix_epochs`` says how many passes read a document."""
    with Stored(spark) as stored:
        return mixture.mixed_documents(docs, stored)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("source_mixture", source_mixture),
]

#: Near duplicates, templates and anchors are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    stored = Stored(spark)
    before = None
    for _, stage in STAGES[:-1]:
        after = stored.put(stage(spark, docs, sf_dir))
        if before is not None:
            stored.drop(before)
        docs = before = after
    return STAGES[-1][1](spark, docs, sf_dir)
