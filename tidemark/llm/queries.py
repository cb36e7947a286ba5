"""Registered queries of the training-data operators, with their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bloom_lm,
    decontam,
    hamming_dedup,
    langid_bitmask,
    mixing,
    nra_topk,
    piecewise_hash,
    secret_scan,
    spelling_variants,
    token_alignment,
    toxicity_mil,
    url_lm,
    warc_zip,
)
from tidemark.llm.common import table


def op1_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lm.judge_urls(table(spark, sf_dir, "pages"), url_lm.CONTRACT_RULES)


def op2_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra_topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_mil.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bloom_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_texts(table(spark, sf_dir, "documents"))


def op5_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_language_bitmasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_bitmask.identify(table(spark, sf_dir, "documents"))


def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(table(spark, sf_dir, "pages"))


def op8_hamming_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_seeded_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op11_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise_hash.edited_likeness(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.compare_tokenizers(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_language_model, op2_nra_top_k, op3_toxicity_mil, op4_bloom_language_model, op5_secret_ownership,
        op6_language_bitmasks, op7_warc_zip, op8_hamming_near_dedup, op9_seeded_decontamination, op10_mix_sources,
        op11_piecewise_hash, op12_token_alignment, op13_spelling_variants,
    )
}
SQL: dict[str, str] = {
    "op2_nra_top_k": nra_topk.ORACLE_SQL,
    "op5_secret_ownership": secret_scan.ORACLE_SQL,
    "op7_warc_zip": warc_zip.ORACLE_SQL,
    "op10_mix_sources": mixing.ORACLE_SQL,
}
