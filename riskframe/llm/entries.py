"""Registered queries of the corpus operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import ctw, decontam, hard_negatives, packing, preference, quality_gbt, ranked_search, sharding, simhash_gph, stream_dedup, tagpaths, token_files, toxicity_gru
from riskframe.llm.common import table


def op1_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scores(table(spark, sf_dir, "documents"))


def op2_tag_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpaths.extracted(table(spark, sf_dir, "pages"))


def op3_gbt_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbt.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_gph.near_duplicates(table(spark, sf_dir, "documents"))


def op5_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_gru.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.digest(preference.preference_pairs(table(spark, sf_dir, "conversations")))


def op7_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), added=True)


def op10_stream_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op11_token_bit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.stored_tokens(table(spark, sf_dir, "documents"))


def op12_lemp_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_norm_bucket_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_context_tree_weighting,
    op2_tag_path_extraction,
    op3_gbt_quality,
    op4_simhash_pigeonhole,
    op5_gru_toxicity,
    op6_preference_format,
    op7_bm25_decontamination,
    op8_jump_sharding,
    op9_best_fit_packing,
    op10_stream_exact_dedup,
    op11_token_bit_files,
    op12_lemp_hard_negatives,
    op13_norm_bucket_search,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_preference_format": preference.oracle_sql(),
        "op8_jump_sharding": sharding.oracle_sql(),
        "op10_stream_exact_dedup": stream_dedup.ORACLE_SQL,
        "op12_lemp_hard_negatives": hard_negatives.ORACLE_SQL,
        "op13_norm_bucket_search": ranked_search.ORACLE_SQL,
    }
