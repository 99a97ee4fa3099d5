"""What a materialized table leaves on disk."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertscope.llm.common import SHUFFLE_CLEANUP, materialize, release


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = manager.getAllBlocks()
    names = [blocks.apply(k).name() for k in range(blocks.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_no_shuffle_files_stay_behind(spark):
    before = shuffle_files(spark)
    was = spark.conf.get(SHUFFLE_CLEANUP)
    counts = spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 700).alias("k")).count()
    out = materialize(counts, "cleanup-test")
    assert not shuffle_files(spark) - before
    assert out.agg(F.sum("count")).first()[0] == 5000 and spark.conf.get(SHUFFLE_CLEANUP) == was
    release(out)
