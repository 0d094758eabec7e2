"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm import exact_packing, mixing, quality_rules, repeats, simhash
from tarn.llm.common import table, written


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars for the texts that they have now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail them."""
    return _measured(quality_rules.cleaned(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 224 bytes (about 40 words) that occur twice or more; no document is left out."""
    return _measured(repeats.without_repeats(docs, match=repeats.PASSAGE))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the packed sequences."""
    return exact_packing.packed(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", near_duplicate_stage),
    ("repeat_removal", repeat_stage),
    ("source_mixing", mixing_stage),
    ("exact_packing", packing_stage),
]

#: Fingerprints, repeats and token ids have no SQL form; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
