"""Staged tables."""

import os
import time

from pyspark.sql import functions as F

from pressmill.llm.common import stage


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {
        f"{d}/{f}" for top in folders.localDirsString() for d, _, names in os.walk(top) for f in names if "shuffle_" in f
    }


def test_shuffles_go_once_a_table_is_staged(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, as_set = shuffle_files(spark), spark.conf.get(setting, "false")
    rows = spark.range(20_000).withColumn("k", F.xxhash64("id"))
    shuffled = rows.join(rows.groupBy("k").agg(F.max("id").alias("most")), "k").repartition(5, "most")
    held = stage(shuffled)
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert held.where("id = most").count() == shuffled.count() == 20_000
    assert spark.conf.get(setting, "false") == as_set
