"""The operators applied to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import exact_dedup, fill_middle, frames, html, lexical, near_dedup, packing, passages, quality, secrets, sentencepiece, suffix_dedup, topk
from slotwise.llm.common import table


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Weak-label posterior, score and decision for every document."""
    return quality.classify(table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate string of every document with the forest's score and decision."""
    return secrets.findings(table(spark, folder, "documents"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html.page_texts(table(spark, folder, "pages"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    return sentencepiece.round_trip(table(spark, folder, "documents"))


def op5_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its class by near-duplicate passages of 50 words, and these passages."""
    return passages.repeated_passages(table(spark, folder, "documents"))


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Ten nearest by inner product for every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    return topk.exact_top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost"
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return exact_dedup.duplicate_groups(table(spark, folder, "documents")).drop("keep_rows")


def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with what is left after removing repeated strings of 200 bytes."""
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets are 85 % alike."""
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op11_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as ids in files of frames, and what these files give back."""
    files = frames.write_tokens(table(spark, folder, "documents"))
    return frames.read_tokens(files).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 documents that rank highest for each benchmark item."""
    found = lexical.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnRenamed("query_id", "item_id")


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in its form, and whether its text can be had back."""
    rows = fill_middle.transform(table(spark, folder, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_quality_classifier, op2_secret_scan, op3_html_extraction, op4_sentencepiece, op5_passage_dedup, op6_exact_top_k,
        op7_packing, op8_exact_dedup, op9_suffix_array_dedup, op10_minhash_near_dedup,
        op11_token_frames, op12_ranked_search, op13_fill_in_middle,
    )
    return {f.__name__: f for f in listed}
