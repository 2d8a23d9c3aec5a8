import pytest
from pyspark.sql import functions as F

from tidewater.session import work_dir
from tidewater.sinks import (
    apply_dim_config,
    merge_history,
    overwrite_partition,
    read_snapshot,
    rebucket,
    scan_snapshot,
    upsert_cells,
    upsert_snapshot,
    vacuum,
    write_day_buckets,
)
from tidewater.sources import (
    SYNC_TYPES,
    create_table,
    ingest_inc,
    load_device_records,
    map_type,
    read_json_lines,
    scan,
    snake_to_camel,
    warehouse_schema,
)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema).withColumn("dt", F.col("dt").cast("date"))


def test_history_merge_is_idempotent(spark, rows):
    path = work_dir(spark, "h")
    first = frame(spark, [("2024-01-01", 1), ("2024-01-01", 1)], "dt string, n int")
    second = frame(spark, [("2024-01-02", 2)], "dt string, n int")
    merge_history(spark, path, first)
    merge_history(spark, path, second)
    assert merge_history(spark, path, second).count() == 2
    replaced = merge_history(spark, path, frame(spark, [("2024-01-02", 3)], "dt string, n int"))
    assert rows(replaced, "n") == [(1,), (3,)]


def test_only_the_given_day_is_replaced(spark, rows):
    path = work_dir(spark, "p")
    overwrite_partition(frame(spark, [("2024-01-01", 1), ("2024-01-02", 2)], "dt string, n int"), path)
    overwrite_partition(spark.createDataFrame([(9,)], "n int"), path, "2024-01-02")
    assert rows(spark.read.parquet(path), "n") == [(1,), (9,)]
    assert rows(scan(spark.read.parquet(path), "20240102"), "n") == [(9,)]


def test_snapshot_replay_and_versions(spark, rows):
    path = work_dir(spark, "s")
    schema = "k string, v string, ts bigint"
    upsert_snapshot(spark, spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 1)], schema), ["k"], ["ts"], path, 0)
    batch = spark.createDataFrame([("a", "3", 1), ("c", "1", 1)], schema)
    for _ in range(2):
        upsert_snapshot(spark, batch, ["k"], ["ts"], path, 1)
    assert rows(read_snapshot(spark, path), "k", "v") == [("a", "3"), ("b", "1"), ("c", "1")]
    upsert_snapshot(spark, batch, ["k"], ["ts"], path, 2, last_batch_wins=False, deleted=F.col("k") == "c")
    assert rows(read_snapshot(spark, path), "k") == [("a",), ("b",)]
    for i in range(3, 8):
        upsert_snapshot(spark, batch, ["k"], ["ts"], path, i)
    assert scan_snapshot(spark, path, 1).count() == 1


def test_only_touched_buckets_are_written(spark, rows):
    path, schema = work_dir(spark, "buckets"), "k bigint, v string, ts bigint"
    base = spark.range(200).selectExpr("id k", "'old' v", "0L ts")
    upsert_snapshot(spark, base, ["k"], ["ts"], path, 0, buckets=8)
    first = {f for f in read_snapshot(spark, path).inputFiles()}
    touched = upsert_snapshot(spark, spark.createDataFrame([(7, "new", 1)], schema), ["k"], ["ts"], path, 1)
    second = {f for f in read_snapshot(spark, path).inputFiles()}
    assert len(second) == len(first) == 8 and len(first & second) == 7
    assert touched.where("k = 7 and v = 'new'").count() == 1 and touched.count() < 60
    assert rows(read_snapshot(spark, path).groupBy("v").count(), "v", "count") == [("new", 1), ("old", 199)]
    upsert_snapshot(spark, spark.createDataFrame([(7, "new", 1)], schema), ["k"], ["ts"], path, 1)
    assert set(read_snapshot(spark, path).inputFiles()) == second
    with pytest.raises(ValueError, match="older"):
        upsert_snapshot(spark, base, ["k"], ["ts"], path, 0)


def test_an_unfinished_batch_is_not_seen(spark, rows):
    path, schema = work_dir(spark, "torn"), "k string, v string, ts bigint"
    upsert_snapshot(spark, spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], schema), ["k"], ["ts"], path, 0, buckets=2)
    spark.createDataFrame([("x", "9", 9)], schema).selectExpr("*", "0 as of_bucket").write.partitionBy("of_bucket").parquet(f"{path}/data/of_batch=1")
    assert rows(read_snapshot(spark, path), "k", "v") == [("a", "1"), ("b", "1")]
    upsert_snapshot(spark, spark.createDataFrame([("a", "2", 2)], schema), ["k"], ["ts"], path, 1)
    assert rows(read_snapshot(spark, path), "k", "v") == [("a", "2"), ("b", "1")]


def test_new_columns_deletions_other_buckets_and_vacuum(spark, rows):
    path = work_dir(spark, "wide")
    upsert_snapshot(spark, spark.createDataFrame([("a", 1), ("b", 1)], "k string, ts bigint"), ["k"], ["ts"], path, 0, buckets=4)
    more = spark.createDataFrame([("a", 2, "x"), ("b", 2, "gone")], "k string, ts bigint, v string")
    upsert_snapshot(spark, more, ["k"], ["ts"], path, 1, deleted=F.col("v") == "gone")
    assert rows(read_snapshot(spark, path), "k", "ts", "v") == [("a", 2, "x")]
    rebucket(spark, path, 2, 3)
    upsert_snapshot(spark, spark.createDataFrame([("c", 1)], "k string, ts bigint"), ["k"], ["ts"], path, 3)
    want = [("a", 2, "x"), ("c", 1, None)]
    assert rows(read_snapshot(spark, path), "k", "ts", "v") == want
    assert vacuum(spark, path, keep=1) == [0, 1, 2] and rows(read_snapshot(spark, path), "k", "ts", "v") == want
    assert vacuum(spark, path, keep=1) == []


def test_cells_of_a_key(spark):
    path, schema = work_dir(spark, "cells"), "k string, c map<string,string>, at bigint"
    upsert_cells(spark, spark.createDataFrame([("u", {"a": "1", "b": "1"}, 5), ("u", {"a": "0"}, 1), ("w", {"a": "9"}, 1)], schema),
                 "k", "c", "at", path, 0)
    upsert_cells(spark, spark.createDataFrame([("u", {"b": "2", "c": "3"}, 2)], schema), "k", "c", "at", path, 1)
    got = {r.k: (r["at"], {n: c.value for n, c in r.cells.items()}) for r in read_snapshot(spark, path).collect()}
    assert got == {"u": (5, {"a": "1", "b": "2", "c": "3"}), "w": (1, {"a": "9"})}


def test_nulls_do_not_overwrite(spark, rows):
    path = work_dir(spark, "n")
    schema = "k string, a string, b string, ts bigint"
    upsert_snapshot(spark, spark.createDataFrame([("x", "1", "1", 1)], schema), ["k"], ["ts"], path, 0, skip_nulls=True)
    upsert_snapshot(spark, spark.createDataFrame([("x", None, "2", 2)], schema), ["k"], ["ts"], path, 1, skip_nulls=True)
    assert rows(read_snapshot(spark, path), "a", "b") == [("1", "2")]


def test_day_buckets(spark, rows):
    df = spark.createDataFrame([(1, "1704067200"), (2, "1704067200000"), (3, "x"), (4, None)], "i int, t string")
    out = write_day_buckets(df, "t", work_dir(spark, "b"))
    assert rows(out, "i", "day") == [(1, "20240101"), (2, "20240101"), (3, "error_bucket"), (4, "error_bucket")]


def test_config_creates_and_drops_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dims")
    changes = spark.createDataFrame(
        [("c", None, "one"), ("r", None, "two"), ("u", "two", "three"), ("d", None, None)],
        "op string, before_table string, after_table string")
    apply_dim_config(spark, changes, lambda name: "row_key string", "dims")
    assert {t.name for t in spark.catalog.listTables("dims")} == {"one", "two", "three"}
    apply_dim_config(spark, spark.createDataFrame([("d", "one", None)], changes.schema), lambda name: "", "dims")
    assert {t.name for t in spark.catalog.listTables("dims")} == {"two", "three"}


def test_newest_configuration_change_counts(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS newest")
    changes = spark.createDataFrame(
        [("c", None, "gone", 1), ("d", "gone", None, 2), ("d", "back", None, 1), ("c", None, "back", 2)],
        "op string, before_table string, after_table string, ts_ms bigint")
    apply_dim_config(spark, changes, lambda name: "row_key string", "newest")
    assert {t.name for t in spark.catalog.listTables("newest")} == {"back"}


def test_empty_rerun_clears_its_day(spark):
    path = work_dir(spark, "empty")
    overwrite_partition(spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt string, n int"), path)
    overwrite_partition(spark.createDataFrame([], "n int"), path, "2024-01-02")
    assert [r.n for r in spark.read.parquet(path).collect()] == [1]


def test_types_and_ddl(spark):
    assert [map_type(t) for t in ("bigint(20)", "int unsigned", "tinyint(1)", "decimal(16, 2)", "varchar(20)", "datetime",
                                  "point")] == ["bigint", "int", "tinyint", "decimal(16,2)", "string", "string", "string"]
    assert warehouse_schema([("id", "bigint"), ("at", "datetime")]).simpleString() == "struct<id:bigint,at:string>"
    create_table(spark, "ods_sample", [("id", "bigint(20)"), ("name", "varchar(8)")])
    assert [f.simpleString() for f in spark.table("ods_sample").schema] == ["id:bigint", "name:string", "dt:date"]
    assert sum(v == "full" for v in SYNC_TYPES.values()) == 16 and sum(v == "inc" for v in SYNC_TYPES.values()) == 10
    assert snake_to_camel("sink_row_key") == "sinkRowKey"


def test_incremental_ingest(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 00:00:00")], "i int, create_time string")
    assert rows(ingest_inc(df, "create_time", "2024-01-02"), "i") == [(2,)]


def test_text_sources(spark, tmp_path):
    good = '{"log_id":"1","device":{"brand":"b"},"gis":{"ip":"1.2.3.4"},"ts":1.5,"keywords":["k"]}'
    (tmp_path / "a.txt").write_text(good + "\nnope\n")
    out = load_device_records(spark, str(tmp_path / "a.txt")).collect()
    assert len(out) == 1 and out[0]["ip"] == "1.2.3.4" and out[0]["brand"] == "b"
    lines = read_json_lines(spark, str(tmp_path / "a.txt"), "log_id string")
    assert lines.where("`_corrupt_record` is not null").count() == 1
