"""Streams against batch, late rows, keyed state."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tidewater.operators import cdc
from tidewater.session import work_dir
from tidewater.sinks import read_snapshot, snapshot_writer
from tidewater.streaming import interval_join, jobs, order_stats, run_available, with_event_time
from tidewater.streaming.lateness import Input, gather, sorting_sink
from tidewater.streaming.run import start
from tidewater.streaming.stateful import dedup_bloom, dedup_exact, keep_newest, snapshot_completion, use_rocksdb

LINE = "order_id bigint, sku_id bigint, user_id bigint, sku_num bigint, order_price double, split_total_amount double, event_time bigint"


def files(spark, path, batches, schema):
    """One file per batch, in order; the stream reads one file per micro-batch."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(1.1 if i + 1 < len(batches) else 0)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def line(user, second, num=1, price=2.0, total=None, sku=1):
    return (user, sku, user, num, price, total, second * 1000)


def test_late_rows(spark, tmp_path, rows):
    batches = [[line(1, 10), line(2, 20)], [line(3, 125)], [line(7, 126)], [line(4, 121), line(5, 30)], [line(6, 1000)]]
    stream = files(spark, tmp_path / "in", batches, LINE)
    got = run_available(spark, jobs.order_window({"order_detail": stream})["order_stats"], "late")
    # The row at 121 s lies behind the watermark but its window is open; the one at 30 s comes after its window closed.
    assert rows(got, "stt", "order_ct", "order_user_ct") == [(0, 2, 2), (120000, 3, 3)]


def sort(spark, tmp_path, streams, inputs, **how):
    """Runs the sorting sink; the outputs by name, as a stream of one file a batch or as a table."""
    schemas = {}

    def write(name, rows, batch_id):
        schemas[name] = rows.schema
        rows.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / name / f"batch={batch_id:04d}"))

    run_available(spark, gather(streams), "sort", sink=sorting_sink(inputs, str(tmp_path / "highs"), write, **how))

    def output(name, stream=False):
        reader = spark.readStream.option("maxFilesPerTrigger", 1) if stream else spark.read
        return reader.schema(schemas[name]).parquet(str(tmp_path / name / "batch=*"))

    return output


def test_late_and_undated_rows_are_outputs(spark, tmp_path, rows):
    batches = [[line(1, 10), line(2, 20), line(8, 0)], [line(3, 125)], [line(7, 126)], [line(4, 121), line(5, 30), line(9, 0)], [line(6, 1000)]]
    stream = files(spark, tmp_path / "in", batches, LINE)
    output = sort(spark, tmp_path, {"order_detail": stream}, jobs.INPUTS["order_window"], window_ms=60_000)
    assert rows(output("order_detail_late"), "user_id") == [(5,)]
    assert rows(output("order_detail_dirty"), "user_id") == [(8,), (9,)]
    assert rows(output("order_detail"), "user_id") == [(1,), (2,), (3,), (4,), (6,), (7,)]
    got = run_available(spark, jobs.order_window({"order_detail": output("order_detail", True)})["order_stats"], "sorted")
    assert rows(got, "stt", "order_ct", "order_user_ct") == [(0, 2, 2), (120000, 3, 3)]


def test_a_repeated_batch_is_sorted_alike(spark, tmp_path):
    out, inputs = {}, {"a": Input(["s"], 1000, "seconds")}
    sink = sorting_sink(inputs, str(tmp_path / "highs"), lambda name, df, i: out.setdefault((name, i), []).append(sorted(map(tuple, df.collect()))))
    parts = [[(1, 100), (2, 90)], [(3, 200), (4, 50), (5, None)], [(6, 198), (7, 200)], []]
    for i, part in enumerate(parts):
        for _ in range(2):
            sink(gather({"a": spark.createDataFrame(part, "id int, s bigint")}), i)
    assert all(a == b for a, b in out.values())
    ids = {k: [r[0] for r in v[0]] for k, v in out.items()}
    assert (ids["a", 0], ids["a", 1], ids["a_late", 1], ids["a_dirty", 1], ids["a", 2], ids["a_late", 2]) == ([1, 2], [3], [4], [5], [7], [6])
    assert ids["a", 3] == ids["a_late", 3] == ids["a_dirty", 3] == []


@pytest.mark.parametrize("idle_seconds", [None, 600])
def test_a_silent_input_does_not_hold_results_back(spark, tmp_path, rows, idle_seconds):
    pay = "order_id bigint, user_id bigint, total_amount double, event_time bigint"
    lines = files(spark, tmp_path / "lines", [[line(1, 10)], [line(2, 20_000)], [line(3, 40_000)]], LINE)
    paid = files(spark, tmp_path / "paid", [[(1, 1, 30.0, 12_000)]], pay)
    output = sort(spark, tmp_path, {"payment": paid, "order_detail": lines}, jobs.INPUTS["payment_window"],
                  idle_ms=None if idle_seconds is None else idle_seconds * 1000)
    streams = {n: output(n, True) for n in ("payment", "order_detail")}
    got = run_available(spark, jobs.payment_window(streams)["payment_stats"], "idle")
    assert rows(got, "stt", "payment_ct") == ([] if idle_seconds is None else [(0, 1)])
    if idle_seconds:
        beats = rows(output("payment").where("heartbeat is not null"), "order_id", "event_time", "heartbeat")
        assert beats == [(None, 19_400_000, 19_400_000), (None, 39_400_000, 39_400_000)]


def test_stream_equals_batch(spark, tmp_path, rows):
    batch = [line(u, s, n, 1.5, t, u % 3) for u, s, n, t in [(1, 1, 2, None), (1, 2, 1, 9.5), (2, 61, 3, None), (3, 62, 1, 1.0)]]
    df = spark.createDataFrame(batch, LINE)
    want = order_stats(with_event_time(df, "event_time"))
    stream = files(spark, tmp_path / "in", [batch, [line(9, 9999, sku=99)]], LINE)
    got = run_available(spark, order_stats(with_event_time(stream, "event_time")), "same")
    assert rows(got) == rows(want)


def test_arrival_time_windows(spark, rows):
    df = spark.createDataFrame([line(1, 1), line(2, 500)], LINE).withColumn("arrived", F.lit("2024-01-01").cast("timestamp"))
    assert rows(order_stats(df, "arrived"), "order_ct") == [(2,)]


@pytest.mark.parametrize("lower, upper", [(-60, 60), (-7200, 7200), (0, 5), (-30, -10)])
def test_interval_join_equals_brute_force(spark, lower, upper):
    make = lambda seed, n: [(i, (i * seed) % 3 if i % 3 else 0, (i * seed * 7919) % 200_000) for i in range(n)]
    left, right = make(3, 300), make(5, 300)
    schema = "id int, k int, ms bigint"
    ts = F.timestamp_millis("ms")
    a = spark.createDataFrame(left, schema).withColumn("t", ts)
    b = spark.createDataFrame(right, schema).withColumn("t", ts)
    got = sorted(tuple(r) for r in interval_join(a, b, ("k", "k"), ("t", "t"), lower, upper, "r_").select("id", "r_id").collect())
    want = sorted((i, j) for i, k, t in left for j, m, s in right
                  if k == m and t + lower * 1000 <= s <= t + upper * 1000)
    assert got == want


def test_payment_lines_by_line_amount(spark, rows):
    pay = spark.createDataFrame([(1, 1, 30.0, 1000)], "order_id bigint, user_id bigint, total_amount double, event_time bigint")
    lines = spark.createDataFrame([line(1, 5, total=10.0, sku=1), line(1, 6, total=20.0, sku=2)], LINE)
    frames = {"payment": pay, "order_detail": lines}
    assert [float(r[0]) for r in jobs.paid_lines(frames).select("payment_amount").collect()] == [30.0, 30.0]
    by_line = jobs.payment_window(frames, allocate="line")["payment_stats"]
    assert sorted(float(r[0]) for r in by_line.select("payment_amount").collect()) == [10.0, 20.0]
    assert jobs.refund_window({"order_detail": lines}) == {}


def test_daily_totals_are_replaced_not_added(spark, tmp_path, rows):
    schema = "stt bigint, sku_id bigint, order_ct bigint"
    hour = 3600_000
    stream = files(spark, tmp_path / "in", [[(0, 1, 2)], [(hour, 1, 3), (23 * hour, 2, 1)], [(25 * hour, 1, 1)]], schema)
    path = work_dir(spark, "day")
    totals = jobs.daily_totals([stream], ["sku_id"], ["order_ct"]).withColumn("v", F.lit(1))
    run_available(spark, totals, "day", mode="update", sink=snapshot_writer(["dt", "sku_id"], ["v"], path))
    got = rows(read_snapshot(spark, path).withColumn("dt", F.col("dt").cast("string")), "dt", "sku_id", "order_ct")
    assert got == [("1970-01-01", 1, 5), ("1970-01-01", 2, 1), ("1970-01-02", 1, 1)]
    shanghai = jobs.daily_totals([spark.createDataFrame([(15 * hour, 1, 1), (17 * hour, 1, 1)], schema)], ["sku_id"],
                                 ["order_ct"], utc_offset_hours=8)
    assert rows(shanghai.withColumn("dt", F.col("dt").cast("string")), "dt", "order_ct") == [
        ("1970-01-01", 1), ("1970-01-02", 1)]


def test_duplicates_over_batches(spark, tmp_path, rows):
    schema = "id bigint, ms bigint"
    stream = files(spark, tmp_path / "in", [[(1, 1000)] * 50 + [(2, 1000)], [(1, 1000), (3, 2000)]], schema)
    timed = with_event_time(stream, "ms", "1 hour")
    assert rows(run_available(spark, dedup_exact(timed, ["id"]), "dup"), "id") == [(1,), (2,), (3,)]


def test_newest_passes_older_does_not(spark, tmp_path, rows):
    use_rocksdb(spark)
    schema = "user_id bigint, ts_ms bigint, v string"
    stream = files(spark, tmp_path / "in", [[(1, 5, "a"), (1, 5, "a")], [(1, 4, "old"), (2, 1, "b")], [(1, 6, "new")]], schema)
    out = work_dir(spark, "newest")

    def sink(batch, batch_id):
        batch.write.mode("append").parquet(out)

    run_available(spark, keep_newest(stream, ["user_id"], "ts_ms", ttl_ms=None, salt=1), "newest", mode="update", sink=sink)
    assert rows(spark.read.parquet(out), "user_id", "ts_ms", "v") == [(1, 5, "a"), (1, 6, "new"), (2, 1, "b")]


def test_newest_passes_every_newer_row_whatever_the_batches(spark, tmp_path, rows):
    use_rocksdb(spark)
    got = []
    for n, parts in enumerate(([[(1, 1), (1, 3), (1, 5)]], [[(1, 1)], [(1, 3), (1, 1)], [(1, 5)]])):
        stream, out = files(spark, tmp_path / f"in{n}", parts, "user_id bigint, ts_ms bigint"), work_dir(spark, "newest")
        run_available(spark, keep_newest(stream, ["user_id"], "ts_ms", ttl_ms=None, salt=2), "newest", mode="update",
                      sink=lambda batch, _, out=out: batch.write.mode("append").parquet(out))
        got.append(rows(spark.read.parquet(out), "ts_ms"))
    assert got == [[(1,), (3,), (5,)]] * 2


def test_log_bus_knows_devices_of_earlier_batches(spark, tmp_path):
    def page(ms):
        return (json.dumps({"common": {"mid": "m1", "is_new": "1"}, "page": {"page_id": "home"}, "ts": ms}),)

    stream, out = files(spark, tmp_path / "in", [[page(1_000)], [page(3 * 86_400_000)]], "value string"), work_dir(spark, "bus")
    sink = jobs.log_bus_sink(work_dir(spark, "devices"), lambda k, df, n: df.write.parquet(f"{out}/{k}/{n}"))
    run_available(spark, stream, "bus", sink=sink)
    pages = spark.read.parquet(f"{out}/page/0", f"{out}/page/1")
    assert sorted((r.ts, r.is_new) for r in pages.select("ts", "common.is_new").collect()) == [(1_000, "1"), (259_200_000, "0")]


def test_bloom_filter_drops_repeats(spark, tmp_path, rows):
    use_rocksdb(spark)
    stream = files(spark, tmp_path / "in", [[("a",), ("b",), ("a",)], [("b",), ("c",)]], "key string")
    assert rows(run_available(spark, dedup_bloom(stream, "key", 1000, 0.001, buckets=2), "bloom")) == [("a",), ("b",), ("c",)]


def test_bloom_filters_grow_and_go_by_slice(spark, tmp_path):
    use_rocksdb(spark)
    day = lambda n: [(f"{n}-{i}", n * 86_400 + i % 80_000) for i in range(1_500)]
    batches = [day(1) + day(1)[:200], day(1)[100:300] + day(2), day(2)[:700] + day(4), day(4)[:50] + day(1)[:30]]
    stream = files(spark, tmp_path / "in", batches, "key string, s bigint").withColumn("ts", F.timestamp_seconds("s")).withWatermark("ts", "1 day")
    got = run_available(spark, dedup_bloom(stream, "key", 20, 0.02, buckets=1, ts="ts", slice_seconds=86_400), "slices")
    keys = [r.key for r in got.collect()]
    assert len(keys) == len(set(keys))
    # A filter made for 20 keys met 1,500 a slice: what it wrongly drops stays within the rate.
    assert 4_500 * (1 - 0.02) <= len(keys) <= 4_500


def test_configuration_holds_from_change_to_change(spark, rows):
    def config(source, sink, key="id"):
        return {"source_table": source, "sink_table": sink, "sink_row_key": key}

    changes = spark.createDataFrame(
        [("r", None, config("a", "dim_a"), 5), ("u", config("a", "dim_a"), config("a", "dim_b"), 10), ("d", config("a", "dim_b"), None, 20),
         ("c", None, config("a", "dim_c"), 20), ("u", config("a", "dim_c"), config("b", "dim_c"), 30), ("c", None, config("z", "dim_z"), 7)],
        "op string, before map<string,string>, after map<string,string>, ts_ms bigint")
    versions = cdc.config_versions(changes.unionAll(changes.limit(2)))
    assert rows(versions, "source_table", "sink_table", "valid_from", "valid_to") == sorted(
        [("a", "dim_a", None, 10), ("a", "dim_b", 10, 20), ("a", "dim_c", 20, 30), ("b", "dim_c", 30, None), ("z", "dim_z", 7, None)], key=repr)
    texts = [json.dumps({"op": "c", "after": {"id": str(at)}, "source": {"table": t}, "ts_ms": at})
             for t, at in [("a", 1), ("a", 9), ("a", 10), ("a", 20), ("a", 30), ("b", 29), ("b", 31), ("z", None), ("y", 1)]]
    routed = cdc.route_by_versions(cdc.parse_envelope(spark.createDataFrame([(x,) for x in texts], "value string")), versions)
    assert rows(routed.select("sink_table", F.col("ts_ms"))) == sorted(
        [("dim_a", 1), ("dim_a", 9), ("dim_b", 10), ("dim_c", 20), ("dim_c", 31), ("dim_z", None)], key=repr)


def test_config_bus_makes_and_drops_targets(spark, tmp_path, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS bus")

    def text(op, table, row, at):
        return (json.dumps({"op": op, "before" if op == "d" else "after": row, "source": {"table": table}, "ts_ms": at}),)

    def config(op, sink, at):
        return text(op, jobs.CONFIG_TABLE, {"source_table": "a", "sink_table": sink, "sink_row_key": "id"}, at)

    batches = [[text("c", "a", {"id": "1"}, 1), config("c", "dim_one", 5), text("c", "a", {"id": "2"}, 6)],
               [config("d", "dim_one", 8), text("c", "a", {"id": "3"}, 9), text("u", "a", {"id": "2", "n": "x"}, 7)],
               [config("c", "dim_two", 12), text("c", "a", {"id": "4"}, 13), text("c", "a", {"id": "5"}, 7)]]
    stream = files(spark, tmp_path / "in", batches, "value string")
    store = work_dir(spark, "bus")
    run_available(spark, stream, "bus", sink=jobs.config_bus_sink(work_dir(spark, "config"), store, database="bus", schema_of=lambda n: "row_key string"))
    got = read_snapshot(spark, store).select("sink_table", F.col("columns")["id"].alias("id"), "ts_ms")
    assert rows(got) == [("dim_one", "2", 7), ("dim_one", "5", 7), ("dim_two", "4", 13)]
    assert {t.name for t in spark.catalog.listTables("bus")} == {"dim_two"}


def test_snapshot_completion_by_change(spark, tmp_path):
    use_rocksdb(spark)

    def change(op, table):
        return (json.dumps({"op": op, "after": {"id": 1}, "source": {"table": table}, "ts_ms": 1}),)

    stream = files(spark, tmp_path / "in", [[change("r", "a"), change("r", "a"), change("r", "b")], [change("u", "a")]], "value string")
    phased = cdc.with_phase(cdc.parse_envelope(stream)).withColumn("table", F.col("source.table"))
    out = work_dir(spark, "phase")

    def sink(batch, batch_id):
        batch.write.mode("append").parquet(out)

    query = start(snapshot_completion(phased), sink, work_dir(spark, "phase-ck"), "update", {"processingTime": "0 seconds"})
    try:
        found = set()
        for _ in range(60):
            time.sleep(1)
            try:
                found = {tuple(r) for r in spark.read.parquet(out).collect()}
            except Exception:  # noqa: BLE001  nothing written yet
                continue
            if len(found) == 2:
                break
    finally:
        query.stop()
    assert found == {("a", 2, "change"), ("b", 1, "quiet")}


def test_first_days_survive_between_batches(spark, tmp_path, rows):
    day = 86400000
    schema = "mid string, ts bigint"
    stream = files(spark, tmp_path / "in", [[("a", 5 * day)], [("a", 5 * day + 1), ("a", 6 * day), ("b", 6 * day)]], schema)
    out = work_dir(spark, "flags")

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_available(spark, stream, "flags", sink=jobs.first_visit_sink(work_dir(spark, "first"), write))
    assert rows(spark.read.parquet(out), "mid", "ts", "is_new") == [
        ("a", 5 * day, "1"), ("a", 5 * day + 1, "1"), ("a", 6 * day, "0"), ("b", 6 * day, "1")]
