"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.sources.staging import shared_folder, stage

# The characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

__all__ = ["BLANKS", "DOCUMENT_COLUMNS", "table", "stage", "shared_folder", "text_of", "column_batches"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def column_batches(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[list, ...]]:
    """Columns of each batch as Python lists."""
    for batch in batches:
        yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)
