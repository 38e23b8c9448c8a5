"""The corpus pipeline: each stage works on what its predecessor kept. All but the last return the
columns of ``documents``; further columns of a table given to a stage are not carried on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import exact_dedup, near_dedup, packing, quality, secrets
from slotwise.llm.common import DOCUMENT_COLUMNS, stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer rejects go."""
    return quality.keep_good(docs).select(*DOCUMENT_COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_duplicates(docs).select(*DOCUMENT_COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: five words, similarity 0.8."""
    return near_dedup.drop_near_duplicates(docs).select(*DOCUMENT_COLUMNS)


def blanked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced; n_chars follows the text where it changes."""
    before = F.length("text")
    return secrets.blank_secrets(docs.withColumn("_n", before)).withColumn(
        "n_chars", F.when(F.length("text") != F.col("_n"), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document in training sequences of 2048 tokens, with its ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("secret_scan", blanked_secrets),
    ("packing", packed),
]

# Models, sketches and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
