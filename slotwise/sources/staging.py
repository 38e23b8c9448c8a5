"""Cutting lineage where several jobs, or several branches of one job, read the same rows.

Staged data lies in the folder named by ``spark.checkpoint.dir``, which all executors share. Only
a local session without that setting gets one, beside its warehouse.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Rows per partition below which spreading a fit further only adds tasks.
PLACED_ROWS = 10_000
# Frees a write's shuffle files when it ends, not when the driver next happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/slotwise-work"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write once as Parquet and go on from there: later readers get column pruning, measured
    sizes for the choice of joins, and a short plan. No one reads the shuffles behind it again, so
    they are freed at once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def place(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Hash the rows over partitions and order them there, both by their key, so that a seeded fit
    depends neither on how its input was partitioned nor on the session. Few rows get few partitions:
    a fit is many short jobs over them."""
    partitions = max(1, -(-rows // PLACED_ROWS))
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def stage_in_place(df: DataFrame) -> DataFrame:
    """Checkpoint with partitions and row order kept, for fits whose result depends on them."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
