import os
import time

from pyspark.sql import functions as F

from dialtrail.operators.staging import SHUFFLES_GO, staged


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = env.blockManager().diskBlockManager().localDirsString()
    return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_staging_leaves_no_shuffle_files(spark):
    """Files of the write's shuffles go with it, whether garbage is collected or not."""
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLES_GO, None)
    rows = spark.range(10_000).select("id", (F.col("id") % 100).alias("k"))
    table = staged(rows.repartition(5, "k").groupBy("k").agg(F.sum("id").alias("s")), "numbered")
    again = staged(rows.repartition(7, "id").groupBy("k").count(), "counts")
    for _ in range(50):
        mine = shuffle_files(spark) - before
        if not mine:
            break
        time.sleep(0.2)
    assert not mine
    assert table.count() == again.count() == 100 and spark.conf.get(SHUFFLES_GO, None) == setting
