"""Stages that outlive a block and stages that go with it."""

from pathlib import Path

from pyspark.sql import functions as F

from sectorlens.llm.stages import scratch, stored


def folder_of(df):
    return Path(df.inputFiles()[0].removeprefix("file://")).parent


def test_only_kept_stages_outlive_a_block(spark):
    with scratch(spark) as keep:
        first = stored(spark.range(10))
        gone = folder_of(first)
        with scratch(spark) as keep_inside:
            second = stored(first.where("id > 2"))
            inner = folder_of(second)
            third = keep_inside(second.agg(F.sum("id").alias("total")))
        assert gone.exists() and not inner.exists() and folder_of(third).exists()
        last = keep(third.withColumn("more", F.lit(1)))
    assert not gone.exists()
    assert [tuple(r) for r in last.collect()] == [(42, 1)]


def test_a_block_that_fails_leaves_nothing(spark):
    try:
        with scratch(spark):
            folder = folder_of(stored(spark.range(3)))
            raise ValueError
    except ValueError:
        assert not folder.exists()
