"""The queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_packing, filter_audit, hilbert_shards, language_id, mixing, personal_data, projection_dedup, quality_rules, repeats, simhash, token_files, trie_counts, whitening
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op7_exact_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_packing.packed(table(spark, sf_dir, "documents"))


def op8_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shards(table(spark, sf_dir, "documents"))


def op10_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_counts(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.found(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_projection_dedup": op3_projection_dedup,
    "op4_language_id": op4_language_id,
    "op5_token_files": op5_token_files,
    "op6_source_mixing": op6_source_mixing,
    "op7_exact_packing": op7_exact_packing,
    "op8_trie_token_counts": op8_trie_token_counts,
    "op9_hilbert_sharding": op9_hilbert_sharding,
    "op10_repeat_removal": op10_repeat_removal,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_personal_data": op12_personal_data,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {"op1_quality_rules": quality_rules.ORACLE, "op6_source_mixing": mixing.ORACLE, "op13_filter_audit": filter_audit.SQL}
