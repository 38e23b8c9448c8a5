from pyspark.sql import functions as F

from slotwise.sources.staging import FREE_SHUFFLES, stage


def shuffle_files(spark):
    """Names of the shuffle files that the local executor keeps."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(blocks.size()) if (name := blocks.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}


def test_staging_leaves_no_shuffle_files_and_can_be_repeated(spark):
    before, mine = spark.conf.get(FREE_SHUFFLES), shuffle_files(spark)
    counts = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    assert stage(counts).count() == stage(counts).count() == counts.count() == 700
    kept = shuffle_files(spark) - mine
    stage(counts)
    assert shuffle_files(spark) - mine <= kept
    assert spark.conf.get(FREE_SHUFFLES) == before
