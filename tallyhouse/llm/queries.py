"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import (
    linededup,
    lmscore,
    mixing,
    neardup,
    packing,
    quality,
    runs,
    simhash,
    substring,
    tokenids,
    toxicity,
    urls,
    whitening,
)
from tallyhouse.llm.common import documents
from tallyhouse.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity_report(documents(spark, sf_dir), labels)


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": toxicity_query,
    "op2_fingerprints": lambda spark, d: simhash.fingerprint_report(documents(spark, d)),
    "op3_token_ids": lambda spark, d: tokenids.token_report(documents(spark, d)),
    "op4_lm_scoring": lambda spark, d: lmscore.score_documents(documents(spark, d)),
    "op5_best_fit_packing": lambda spark, d: packing.pack_documents(documents(spark, d)),
    "op7_url_filters": urls.url_report,
    "op8_quality_rules": lambda spark, d: quality.quality_report(documents(spark, d)),
    "op6_substring_dedup": lambda spark, d: substring.removal_report(documents(spark, d)),
    "op9_minhash_near_dedup": lambda spark, d: neardup.class_report(documents(spark, d)),
    "op10_mixing": lambda spark, d: mixing.mix_report(documents(spark, d)),
    "op11_periodic_runs": lambda spark, d: runs.runs_report(documents(spark, d)),
    "op12_line_dedup": lambda spark, d: linededup.line_report(documents(spark, d)),
    "op13_embedding_whitening": whitening_query,
}

__all__ = ["QUERIES", "SQL"]
