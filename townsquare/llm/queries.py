"""Registered queries of the text operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from townsquare.llm import (
    decontamination,
    fingerprints,
    language_id,
    language_model,
    licenses,
    line_rules,
    mixture,
    near_duplicates,
    prefix_trie,
    private_data,
    repeated_text,
    spelling,
    token_counts,
)
from townsquare.llm.common import Stored, table
from townsquare.llm.oracles import ORACLES


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op2_repeated_text(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return repeated_text.remove(table(spark, folder, "documents"), stored)


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return licenses.scan(table(spark, folder, "documents"), stored)


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return near_duplicates.join(table(spark, folder, "documents"), stored).select(
            "doc_id", "class_id", "n_links", "group_id", "kept"
        )


def op5_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return mixture.mix(table(spark, folder, "documents"), stored).select(
            "doc_id", "size", "source_size", "target", "taken", "source", "epochs", "copies"
        )


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return private_data.scan(table(spark, folder, "documents"))


def op7_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return decontamination.label(table(spark, folder, "documents"), table(spark, folder, "benchmark"), stored)


def op8_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return line_rules.judge(table(spark, folder, "documents"), stored).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            F.col("removed_words"),
        )


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count(table(spark, folder, "documents"))


def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return language_model.score(table(spark, folder, "documents"), stored)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return prefix_trie.report(table(spark, folder, "conversations"), stored)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return spelling.variants(table(spark, folder, "documents"), stored)


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    with Stored(spark) as stored:
        return fingerprints.edited_pairs(table(spark, folder, "documents"), stored)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_repeated_text": op2_repeated_text,
    "op3_license_scan": op3_license_scan,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_source_mixture": op5_source_mixture,
    "op6_personal_data": op6_personal_data,
    "op7_benchmark_leaks": op7_benchmark_leaks,
    "op8_line_rules": op8_line_rules,
    "op9_token_counts": op9_token_counts,
    "op10_language_model": op10_language_model,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fingerprints": op13_fingerprints,
    "pipeline": corpus_pipeline.run,
}

__all__ = ["ORACLES", "QUERIES"]
