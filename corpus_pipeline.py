"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import mixing, neardup, packing, quality, substring
from tallyhouse.llm.common import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines their host repeats too often."""
    return quality.keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; emptied ones stay, empty."""
    return substring.drop_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight wants it."""
    return mixing.keep_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: The rounding of the mix and the tokenizer of the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored in the shared folder before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace("_", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
