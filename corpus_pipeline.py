"""Corpus pipeline: documents in, a training mix out, in the stages of STAGES.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on every row that the one
before it kept. run() writes each stage's rows to the shared scratch folder and reads them again,
so that a stage's lineage ends with it. No table has rows of its own: empty ones give an empty mix,
nulls and repeated rows are each stage's to judge, as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pliego.llm import decontaminate, jaccard, mixing, quality, secrets
from pliego.llm.cluster import dropped, saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest doc_id."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked, and n_chars, if there is one, counted again where the text changed. Null texts stay null."""
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.when(F.col("text").contains(secrets.MASK), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in training order: its text and language, how many words are taken, and the position of every copy.

    Documents without words, and null texts, are not taken and come last, with null positions.
    """
    kept = tuple(c for c in ("text", "lang", "n_chars") if c in docs.columns)
    return mixing.in_training_order(mixing.mix(docs, keep=kept)).select("doc_id", "source", *kept, "size", "source_size", "target", "taken", "position", "positions")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mix),
]

#: The stages' models and similarity search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    last = None
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
        if last is not None:
            dropped(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
