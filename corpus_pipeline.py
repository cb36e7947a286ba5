"""The training-corpus pipeline: each stage reads what its predecessor kept.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared folder and hands the reread table to the next stage. All stages but the last
return the columns of documents; the last adds size, source_size, target and taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, hamming_dedup, mixing, secret_scan, toxicity_mil
from tidemark.llm.common import materialise, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model finds toxic go."""
    return toxicity_mil.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return hamming_dedup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific secrets are replaced in the text; every document stays."""
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

# SQL cannot express the learned and alignment stages; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
