"""Registered queries of the text operators: thin views over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cirrus.llm import decontam, gam, hilbert, lang_kernel, lm_score, merkle, mixing, order_minhash, periodic, pii, quality_rules
from cirrus.llm import token_scan, toxicity
from cirrus.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(read_table(spark, sf_dir, "documents"))


def op5_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(read_table(spark, sf_dir, "documents"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op8_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.sharded_sizes(read_table(spark, sf_dir, "documents"))


def op11_scale_tiled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_documents(read_table(spark, sf_dir, "documents"))


def op12_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_kernel.languages_of(read_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_quality_gam, op3_cross_entropy_difference, op4_separator_scan, op5_systematic_mix,
        op6_order_minhash, op7_personal_data, op8_positional_index, op9_toxicity_chain, op10_hilbert_shards,
        op11_scale_tiled_runs, op12_string_kernel_language, op13_merkle_manifest,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op8_positional_index": decontam.ORACLE_SQL,
    "op11_scale_tiled_runs": periodic.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
