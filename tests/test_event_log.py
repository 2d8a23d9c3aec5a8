"""The event log: offsets, restarts, partitions that appear later, tombstones, repeated batches."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import cdc
from tidewater.session import work_dir
from tidewater.sources.event_log import append_log, ends, read_log, segments

ROW = "topic string, key string, value string, timestamp long"


def records(topic, numbers, value="v{}"):
    return [(topic, f"k{i}", value.format(i) if i % 7 else None, 1_700_000_000_000 + i) for i in numbers]


def test_restart_goes_on_where_it_stopped(spark, rows):
    log, out, checkpoint = (work_dir(spark, n) for n in ("log", "rows", "checkpoint"))

    def run():
        stream = read_log(spark, log, ["a", "b"])
        stream.writeStream.option("checkpointLocation", checkpoint).option("path", out).format("parquet").trigger(availableNow=True).start().awaitTermination()
        got = spark.read.parquet(out)
        assert got.count() == got.select("topic", "partition", "offset").distinct().count()
        return sorted((r.topic, r.key, r.value) for r in got.collect())

    want = records("a", range(1, 40))
    append_log(spark.createDataFrame(want, ROW), log, 0, partitions=2)
    assert run() == sorted((t, k, v) for t, k, v, _ in want)
    more = records("a", range(40, 60)) + records("b", range(10)) + records("c", range(5))
    append_log(spark.createDataFrame(more, ROW), log, 1, partitions=3)
    want += [r for r in more if r[0] != "c"]
    for _ in range(2):
        assert run() == sorted((t, k, v) for t, k, v, _ in want)
    offsets = spark.read.parquet(out).groupBy("topic", "partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"), F.count("*").alias("n"))
    assert all(r.low == 0 and r.high == r.n - 1 for r in offsets.collect()) and offsets.count() > 3
    assert any(r.value is None for r in spark.read.parquet(out).collect())


def test_repeated_batch_adds_nothing(spark):
    log = work_dir(spark, "log")
    df = spark.createDataFrame(records("a", range(30)) + [("a", None, "no key", None)], ROW)
    append_log(df, log, 5)
    before = ends(segments(log))
    append_log(df, log, 5)
    assert ends(segments(log)) == before and sum(before.values()) == 31
    batch = read_log(spark, log, stream=False)
    assert batch.count() == 31 and batch.where("value = 'no key'").first().timestamp is None
    assert batch.where("key = 'k8'").select(F.unix_millis("timestamp")).first()[0] == 1_700_000_000_008


def test_lost_segments_and_broken_lines(spark):
    log = work_dir(spark, "log")
    append_log(spark.createDataFrame(records("a", range(1, 6)), ROW), log, 0, partitions=1)
    append_log(spark.createDataFrame(records("a", range(8, 13)), ROW), log, 1, partitions=1)
    first = segments(log)[0]
    with open(first.path, "rb") as f:
        lines = f.read().split(b"\n")
    with open(first.path, "wb") as f:
        f.write(b"\n".join([b"not json", *lines[1:]]))
    assert sorted(r.value for r in read_log(spark, log, stream=False).collect())[0] == "not json"
    os.rename(first.path, first.path + ".gone")
    with pytest.raises(Exception, match="are gone"):
        read_log(spark, log, stream=False).collect()
    assert read_log(spark, log, stream=False, failOnDataLoss="false").count() == 5


def test_tombstones_and_envelopes(spark, rows):
    log = work_dir(spark, "log")
    text = '{"op":"c","after":{"id":1},"source":{"table":"t"},"ts_ms":5}'
    append_log(spark.createDataFrame([("a", "1", text, 1), ("a", "2", None, 2), ("a", "3", "broken", 3)], ROW), log, 0)
    parsed = cdc.normalize_cdc(cdc.parse_envelope(read_log(spark, log, stream=False)))
    assert rows(parsed, "_table", "op", "event_time") == [("t", "c", 5)]


def test_no_log_yet(spark):
    assert read_log(spark, work_dir(spark, "none"), stream=False).count() == 0


def test_append_holds_no_more_than_its_open_files(spark, monkeypatch):
    def no_sort(*_):
        raise AssertionError("a sort holds all rows of a task")

    monkeypatch.setattr(type(spark.range(1)), "sortWithinPartitions", no_sort)
    log = work_dir(spark, "log")
    mixed = [r for pair in zip(records("a", range(30)), records("b", range(30))) for r in pair]
    append_log(spark.createDataFrame(mixed, ROW).coalesce(1), log, 0, partitions=3)
    append_log(spark.createDataFrame(mixed, ROW), log, 0, partitions=3)
    got = read_log(spark, log, stream=False).select("topic", "key", "value").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([r[:3] for r in mixed], key=repr)
    found = segments(log)
    assert len(found) == len({(s.topic, s.partition) for s in found}) and sum(ends(found).values()) == 60
