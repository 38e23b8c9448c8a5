"""Telemetry views of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.params import SERIES, TS

SENSORS = ("click", "error", "purchase", "signup", "view")
TARGET = "click"
SERIES_COUNT = 4
MEASURES = ("price", "quantity")
LONG_SENSORS = ("quantity", "price", "discount", "tax")
EMBEDDING_SIZE = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """events: four series, one sensor per event type; each reading fills one sensor."""
    return table(spark, folder, "events").select(
        (F.col("user_id") % SERIES_COUNT).alias(SERIES),
        TS,
        *[F.when(F.col("event_type") == s, F.col("value")).alias(s) for s in SENSORS],
    )


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem: one series per return flag, readings by ship date."""
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias(SERIES), F.col("l_shipdate").alias(TS),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"),
    )


def long_series(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as one series of some 720,000 five-minute slots: lines spread over their ship day."""
    return table(spark, folder, "lineitem").select(
        F.lit(0).cast("bigint").alias(SERIES),
        F.expr(
            "l_shipdate + make_dt_interval(0, 0, cast(pmod(l_orderkey * 7 + l_linenumber * 13, 288) as int) * 5)"
        ).alias(TS),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


def order_values(spark: SparkSession, folder: str) -> DataFrame:
    """orders: one series per priority, readings by order date."""
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias(SERIES), F.col("o_orderdate").alias(TS), F.col("o_totalprice").alias("price")
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """embeddings as one column per dimension."""
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("label"), *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(EMBEDDING_SIZE)]
    )


def export_text(spark: SparkSession, folder: str) -> DataFrame:
    """events as an untyped export: padded headers, unreadable stamps, text among the numbers."""
    text = F.col("value").cast("string")
    return table(spark, folder, "events").select(
        (F.col("user_id") % SERIES_COUNT).alias("machine"),
        F.when(F.col("user_id") % 17 == 0, F.lit("n/a")).otherwise(F.col(TS).cast("string")).alias(" timestamp "),
        F.when(F.col("event_type") == "error", F.concat(text, F.lit(" bad"))).otherwise(text).alias(" reading"),
        F.col("event_id").cast("string").alias("counter "),
        F.col("event_type").alias("kind"),
    )
