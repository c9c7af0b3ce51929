import time

from pyspark.sql import functions as F

from stintlake.session import SHUFFLE_CLEANUP, stage


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_stage_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(10_000).withColumn("k", F.col("id") % 100)
    out = stage(rows.groupBy("k").agg(F.sum("id").alias("n")).repartition(7, "n"), "sums")
    for _ in range(100):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting  # other writes are as before
    assert out.agg(F.count("*"), F.sum("n")).first() == (100, 49_995_000)
