"""Staged tables leave nothing behind but their files."""

import time

from pyspark.sql import functions as F

from payfeed.session import materialize

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffles(spark):
    """Numbers of the shuffles that have files in this process."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(i).name() for i in range(blocks.size())]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before, setting = shuffles(spark), spark.conf.get(FREE_SHUFFLES, None)
    sums = spark.range(20000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    staged = materialize(sums, "sums")
    for _ in range(50):  # files are deleted beside the query's end
        if not shuffles(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffles(spark) - before
    assert spark.conf.get(FREE_SHUFFLES, None) == setting
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, sums.collect()))
