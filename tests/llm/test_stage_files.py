import time

from pyspark.sql import functions as F

from tallybrook.llm import common


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(common._CLEANUP)
    rows = spark.range(20_000).select((F.col("id") % 7).alias("k"), "id").repartition(4, "id")
    kept = common.stage(rows)
    deadline = time.monotonic() + 10
    while _shuffle_files(spark) - before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(common._CLEANUP) == setting
    # the table that was staged can be used again: its shuffle is simply run again
    assert rows.count() == kept.count() == 20_000
