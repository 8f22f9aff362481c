"""The corpus operators' queries on the synthetic tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.llm import chat, decontaminate, jaccard, language, mixing, pii, quality, scoring, secrets, token_counts
from pliego.llm.cluster import table


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), max_tokens=512)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_linked")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_calls(table(spark, sf_dir, "conversations")).withColumnsRenamed({"conv": "conv_id"})


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.in_training_order(mixed).select("doc_id", "size", "source_size", "target", "taken", mixing.places(F.col("positions")).alias("positions"))


def op10_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_secret_scan": op4_secret_scan,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_ppm_scoring": op10_ppm_scoring,
}

ORACLES: dict[str, str] = {"op9_mixing": mixing.PLACES_SQL.format(docs="documents")}
