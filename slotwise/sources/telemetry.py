"""Reading raw telemetry and the tables that the steps hand to one another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.functions.timeslots import null_nan
from slotwise.params import SERIES, TIMESTAMP_NAMES, TS

PERIOD_SCHEMA = f"{SERIES} STRING, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, duration_min DOUBLE"
LABEL_SCHEMA = f"{SERIES} STRING, {TS} TIMESTAMP_NTZ, cluster INT"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"


def stamp_formats(day_first: bool = False) -> tuple[str, ...]:
    """Formats that are tried after ISO text. A bare year is ISO: midnight of 1 January."""
    date = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy") if day_first else ("M/d/yyyy", "M-d-yyyy", "d.M.yyyy")
    dates = (*date, "yyyy/M/d", "MMM d yyyy", "MMM d, yyyy", "d MMM yyyy", "MMMM d, yyyy")
    return tuple(f"{d}{t}" for d in dates for t in (" H:mm[:ss[.SSSSSS]]", " h:mm[:ss] a", ""))


def timestamp_column(names: Sequence[str]) -> str:
    """First accepted timestamp name among the columns, else the first column."""
    return next((c for c in TIMESTAMP_NAMES if c in names), names[0])


def lenient_timestamp(name: str, formats: Sequence[str] = ()) -> Column:
    """ISO text or any of ``formats``; what cannot be read becomes null."""
    tries = [F.col(name).try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(F.trim(F.col(name).cast("string")), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def lenient_number(name: str) -> Column:
    """The number, or null for other text; suffixes such as 1.0d are no numbers."""
    plain = F.col(name).cast("string").rlike(NUMBER)
    return null_nan(F.when(plain, F.col(name).try_cast("double")))


def unreadable_rows(df: DataFrame, *, series: str | None = None, day_first: bool = False) -> DataFrame:
    """How many rows ``clean`` reads and how many it drops for their timestamp or series."""
    df = df.toDF(*[c.strip() for c in df.columns])
    when = timestamp_column([c for c in df.columns if c != series])
    lost = lenient_timestamp(when, stamp_formats(day_first)).isNull()
    if series:
        lost = lost | F.col(series).isNull()
    return df.agg(F.count(F.lit(1)).alias("rows_read"), F.count(F.when(lost, 1)).alias("rows_dropped"))


def clean(
    df: DataFrame, *, series: str | None = None, formats: Sequence[str] | None = None, day_first: bool = False
) -> DataFrame:
    """Raw columns -> ``series_id, ts, sensors``.

    Column names are trimmed, the timestamp column is found by name, rows without a readable
    timestamp are dropped and every other column becomes a number or null. Without a ``series``
    column all rows are one series. ``formats`` replaces ``stamp_formats``, in which 1/2/2024 is the
    second of January unless ``day_first``; ``unreadable_rows`` counts what is dropped.
    """
    formats = stamp_formats(day_first) if formats is None else formats
    df = df.toDF(*[c.strip() for c in df.columns])
    when = timestamp_column([c for c in df.columns if c != series])
    sensors = [c for c in df.columns if c not in (when, series)]
    key = F.col(series) if series else F.lit("0")
    rows = df.select(
        key.alias(SERIES), lenient_timestamp(when, formats).alias(TS), *[lenient_number(c).alias(c) for c in sensors]
    )
    return rows.filter(F.col(TS).isNotNull() & F.col(SERIES).isNotNull())


def read_telemetry(
    spark: SparkSession, path: str, *, series: str | None = None, formats: Sequence[str] | None = None,
    day_first: bool = False,
) -> DataFrame:
    """CSV with a header (every cell read as text, no inference pass) or Parquet."""
    if str(path).rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.csv(path, header=True, inferSchema=False)
    return clean(raw, series=series, formats=formats, day_first=day_first)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a result. Slot tables may be laid out by day or series with ``partition_by``."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_days(
    df: DataFrame, path: str, *, by: Sequence[str] = (SERIES, TS), day: str = "day", rows_per_file: int = 4_000_000
) -> None:
    """Write a slot table as one Parquet folder per day of ``ts``, and on a rerun replace only the days
    that ``df`` holds; other days stay as they are.

    Rows are dealt by ranges of day and ``by`` and ordered by them, so that a day of many rows is written by
    several tasks, each file covers a narrow range of series, and a day of few rows has one file or two.
    ``df`` is read twice, once for the ranges; pass it staged where it is costly.
    """
    rows = df.withColumn(day, F.to_date(F.col(TS)))
    dealt = rows.repartitionByRange(day, *by).sortWithinPartitions(day, *by)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(day).parquet(path)


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, *, day: str = "day") -> DataFrame:
    """Rows of ``write_days``, of the days ``first`` to ``last`` (ISO dates); no other folder is read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col(day) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col(day) <= F.lit(last).cast("date"))
    return rows.drop(day)


def read_periods(spark: SparkSession, path: str, *, fmt: str = "parquet", schema: str = PERIOD_SCHEMA) -> DataFrame:
    return _read(spark, path, fmt, schema)


def read_labels(spark: SparkSession, path: str, *, fmt: str = "parquet", schema: str = LABEL_SCHEMA) -> DataFrame:
    return _read(spark, path, fmt, schema)


def _read(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame:
    if fmt == "csv":
        raw = spark.read.csv(path, header=True, inferSchema=False)
    else:
        raw = spark.read.format(fmt).load(path)
    wanted = StructType.fromDDL(schema).fields

    def column(f):
        # Whole numbers may be written as 0.0.
        text = F.col(f.name)
        return (text.try_cast("double") if f.dataType.simpleString() in ("int", "bigint") else text).try_cast(f.dataType)

    return raw.select(*[column(f).alias(f.name) for f in wanted])
