"""Slot means over arriving readings, independent of the session's time zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.functions.timeslots import epoch_seconds_exact, slot_start
from slotwise.params import SERIES, TS, Params


def read_stream(spark: SparkSession, folder: str, schema, *, fmt: str = "parquet", **options) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def stream_resample(readings: DataFrame, sensors: Sequence[str], params: Params, *, lateness: str) -> DataFrame:
    """Slot means of a stream. A slot is emitted once, when the watermark has passed it; readings
    later than ``lateness`` are dropped."""
    means = (
        instants(readings)
        .withWatermark(TS, lateness)
        .groupBy(SERIES, F.window(TS, f"{params.step} seconds").alias("_w"))
        .agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in sensors])
    )
    slot = F.floor(F.unix_micros("_w.start") / F.lit(params.step * 1_000_000)).cast("bigint")
    return means.withColumn("_slot", slot).select(SERIES, slot_start("_slot", params.step).alias(TS), *sensors)


def instants(readings: DataFrame) -> DataFrame:
    """``ts`` as an instant, its wall clock read as UTC: watermarks need instants, and the session's zone
    must not move a slot."""
    micros = F.round(epoch_seconds_exact(TS) * 1_000_000).cast("bigint")
    return readings.withColumn(TS, F.timestamp_micros(micros))


def wall(name: str) -> Column:
    """Back to the wall clock."""
    micros = F.unix_micros(name)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(micros / F.lit(86_400_000_000)).cast("int"), F.lit(0), F.lit(0),
        (F.pmod(micros, F.lit(86_400_000_000)) / F.lit(1_000_000).cast("decimal(18,6)")).cast("decimal(18,6)"),
    )


def write_stream(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet until everything available has been processed."""
    return (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(folder)
    )
