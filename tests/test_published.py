"""The publishing sink: failed tasks, repeated batches, retries."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.session import work_dir
from tidewater.sinks.published import publish, read_published, retried

SCHEMA = "i bigint, s string"


def test_repeated_batches_count_once(spark):
    path = work_dir(spark, "published")
    df = spark.range(1_000).select(F.col("id").alias("i"), F.col("id").cast("string").alias("s")).repartition(3)
    for batch in (0, 0, 1, 0):
        publish(df, path, batch, batch_size=100)
    rows = read_published(spark, path, SCHEMA)
    assert rows.count() == 2_000 and rows.select("i").distinct().count() == 1_000
    staged = [f for f in os.listdir(f"{path}/staging/0") if f.endswith(".parquet")]
    assert len(staged) >= 10 and len(os.listdir(f"{path}/batches")) == 2


def test_a_failed_batch_leaves_nothing(spark):
    path = work_dir(spark, "failed")

    @F.udf("string")
    def fails(i):
        if i == 77:
            raise RuntimeError("broken row")
        return str(i)

    df = spark.range(100).repartition(4).select(F.col("id").alias("i"), fails("id").alias("s"))
    with pytest.raises(Exception, match="broken row"):
        publish(df, path, 0, batch_size=5)
    assert read_published(spark, path, SCHEMA).count() == 0
    publish(df.where("i <> 77"), path, 0, batch_size=5)
    assert read_published(spark, path, SCHEMA).count() == 99


def test_empty_batch(spark):
    path = work_dir(spark, "empty")
    publish(spark.createDataFrame([], SCHEMA), path, 0)
    assert read_published(spark, path, SCHEMA).count() == 0


def test_retries():
    calls = []

    def step():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "done"

    assert retried(step, 3, 0.001) == "done" and len(calls) == 3
    with pytest.raises(OSError):
        retried(lambda: (_ for _ in ()).throw(OSError("down")), 1, 0.001)
