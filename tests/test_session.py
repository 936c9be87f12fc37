import os

from pyspark.sql import functions as F

from tickloom.session import SHUFFLE_CLEANUP, stored


def shuffle_files(spark):
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for folder in top for _, _, names in os.walk(folder.getPath()) for name in names if name.startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    groups = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")), "groups")
    both = stored(groups.join(spark.range(7).withColumnRenamed("id", "k").repartition(3), "k"), "both")
    assert shuffle_files(spark) <= before
    assert both.agg(F.sum("s")).first()[0] == 499_500
    assert spark.conf.get(SHUFFLE_CLEANUP, None) in (None, "false")


def test_what_is_stored_twice_is_whole_each_time(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 5).alias("k")).count()
    assert sorted(rows.collect()) == sorted(stored(rows).collect()) == sorted(stored(rows).collect()) == sorted(rows.collect())
