"""Exact dedup: group by a 128-bit hash of the content, keep one row, compare bytes inside groups.

Texts are equal when they are identical after deleting blanks. Of equal texts the row with the most
code points stays, then the one with the smallest id.

Only hashes are grouped. The grouping counts (hash, id, length) first, so that a group which holds a
third of all rows is dealt over all tasks and reaches its final task as partial sums. Bytes are
compared as the smallest and the largest text of a group, taken in each map task before the shuffle:
if they are the same, all are. Groups where they aren't (collisions) are cut by the text itself.
Rows find their group by a join whose large keys Spark splits at run time.

Defined results: a null text is empty, and empty texts are one group. A null id comes after all ids.
Rows that repeat both id and text count each in ``group_size`` and give one output row each in
``duplicate_groups``; ``drop_duplicates`` returns one of them. Other columns pass through untouched,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import BLANKS, stage, text_of


def normalised(text: str = "text") -> Column:
    return F.translate(text_of(text), BLANKS, "")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text_of(text_col)).cast("long").alias("n"),
        normalised(text_col).alias("norm"),
    ).withColumn("h", F.md5("norm"))


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: its size, the row that stays, and how often that row is there."""
    single = rows.groupBy(*keys, "doc_id", "n").agg(F.count(F.lit(1)).alias("c"))
    # Ids ascend with nulls last, as the largest struct is taken: a null flag, then the negated id.
    best = F.struct("n", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("minus"), "c")
    return single.groupBy(*keys).agg(F.sum("c").alias("group_size"), F.max(best).alias("best")).select(
        *keys, "group_size", (-F.col("best.minus")).alias("keep_id"), F.col("best.n").alias("keep_n"),
        F.col("best.c").alias("keep_rows"),
    )


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and for
    ``drop_duplicates`` keep_rows (how many rows repeat the one that stays)."""
    rows = stage(_keyed(docs, id_col, text_col).select("doc_id", "n", "h", F.sha2("norm", 256).alias("text_sha256")))
    groups = stage(_groups(rows, ["h"]))
    texts = _keyed(docs, id_col, text_col)
    mixed = stage(
        texts.groupBy("h").agg(F.min("norm").alias("low"), F.max("norm").alias("high")).where("low != high").select("h")
    )
    out = rows.join(groups, "h")
    if not mixed.isEmpty():
        # Hash collisions: the same, with the text in the key.
        met = texts.join(mixed, "h", "left_semi").withColumn("text_sha256", F.sha2("norm", 256))
        cut = met.join(_groups(met, ["h", "norm"]), ["h", "norm"])
        columns = ["doc_id", "n", "text_sha256", "group_size", "keep_id", "keep_n", "keep_rows"]
        out = out.join(mixed, "h", "left_anti").select(*columns).unionByName(cut.select(*columns))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "keep_rows")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = stage(duplicate_groups(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_hash"), F.col("keep_rows").alias("_rows")
    ).distinct())
    # The caller's columns travel in one struct, so that none of their names can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    hashed = docs.select(
        row, F.col(id_col).alias("id"), F.sha2(normalised(text_col), 256).alias("hash"), F.length(text_of(text_col)).alias("n")
    )
    found = hashed.join(kept, F.col("id").eqNullSafe(F.col("_kept_id")) & (F.col("hash") == F.col("_kept_hash")))
    once = found.where("_rows = 1")
    if not kept.where("_rows > 1").isEmpty():
        # A row repeated with its id: one of the copies, whichever other columns it has.
        order = Window.partitionBy("id", "hash").orderBy(F.desc("n"), F.xxhash64("row"))
        again = found.where("_rows > 1").withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")
        once = once.unionByName(again)
    return once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
