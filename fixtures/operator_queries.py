"""Queries for operators that no warehouse job shows by itself."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.envelopes import customer_changes, log_texts, ods_changes, order_changes
from fixtures.plain import plain
from fixtures.retail import phone
from fixtures.tables import EVENT_DAY, ORDER_DAY, Tables, tag
from tidewater import functions as fn
from tidewater.operators import cdc, logs
from tidewater.operators.sequences import step_index
from tidewater.operators.sets import union_all
from tidewater.session import work_dir
from tidewater.sinks import (
    append_partition,
    merge_history,
    overwrite_partition,
    read_snapshot,
    scan_snapshot,
    upsert_snapshot,
    write_day_buckets,
    write_events,
)
from tidewater.sinks.published import publish, read_published
from tidewater.sources import ingest_full, ingest_inc, load_device_records, read_json_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Keys that always get the same bucket.
RESERVED = {"7": "9001", "11": "9002"}


def query(fn_: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    @functools.wraps(fn_)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn_(Tables(spark, sf_dir)))

    QUERIES[fn_.__name__] = run
    return fn_


def operator_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


# ---- change envelopes


@query
def cdc_normalize(t: Tables) -> DataFrame:
    """Payload, table, operation and time of every change, as typed columns."""
    rows = cdc.normalize_cdc(cdc.parse_envelope(order_changes(t.orders)))
    return cdc.typed_payload(rows, "id bigint, user_id bigint, status string, total_amount double",
                             keep=["_table", "op", "event_time"])


@query
def cdc_route(t: Tables) -> DataFrame:
    """Rows of the seven fact streams."""
    rows = cdc.normalize_cdc(cdc.parse_envelope(order_changes(t.orders)))
    routed = rows.withColumn("stream", cdc.fact_stream(F.col("_table"), F.col("op"))).where(F.col("stream").isNotNull())
    return cdc.typed_payload(routed, "id bigint", keep=["op", "event_time", "stream"])


@query
def cdc_after(t: Tables) -> DataFrame:
    after = cdc.extract_after(cdc.parse_envelope(ods_changes(t.orders)))
    return after.select("__op", "__table", "__pk", "ts_ms", "dt", "after")


@query
def topic_route(t: Tables) -> DataFrame:
    """Topics of the raw copy, of the extracted rows and of the detail layer, with their row counts."""
    envelopes = cdc.parse_envelope(ods_changes(t.orders))
    after = cdc.extract_after(envelopes)
    topics = union_all([
        envelopes.select(cdc.ods_topic(F.col("source.table"), raw=True).alias("topic")),
        cdc.parse_envelope(order_changes(t.orders)).select(cdc.ods_topic(F.col("source.table"), raw=True).alias("topic")),
        after.select(cdc.ods_topic(F.col("__table"), raw=False).alias("topic")),
        after.select(cdc.dwd_topic(F.col("__table")).alias("topic"))])
    return topics.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query
def config_clean(t: Tables) -> DataFrame:
    """Configuration changes with the table before and after."""
    key = F.col("s_suppkey")
    from fixtures.envelopes import LETTERS, envelope, pick

    row = F.struct(F.col("s_name").alias("source_table"), tag("dim_", key).alias("sink_table"))
    texts = t.supplier.select(envelope(F.lit("table_process_dim"), pick(LETTERS, key), row, key).alias("value"))
    return cdc.clean_config_cdc(cdc.parse_envelope(texts)).select("op", "before_table", "after_table", "ts_ms")


@query
def snapshot_phase(t: Tables) -> DataFrame:
    phased = cdc.with_phase(cdc.parse_envelope(ods_changes(t.orders)))
    return phased.groupBy(F.col("source.table").alias("table"), "phase").agg(F.count(F.lit(1)).alias("n"))


@query
def dim_route(t: Tables) -> DataFrame:
    """Customer changes routed by the dimension configuration."""
    config = t.spark.range(1).select(
        F.lit("customer").alias("source_table"), F.lit("dim_customer").alias("sink_table"),
        F.lit("c_custkey").alias("sink_row_key"))
    return cdc.route_by_config(cdc.parse_envelope(customer_changes(t.customer)), config)


@query
def user_dim_salted(t: Tables) -> DataFrame:
    """Salted keys of inserted and updated users."""
    after = cdc.extract_after(cdc.parse_envelope(ods_changes(t.orders)))
    good, _ = cdc.user_dim_rows(after.where(F.col("__table") == "ods_user_info"))
    return good.select("row_key", "user_id", "ts_ms")


# ---- logs


def _logs(t: Tables) -> tuple[DataFrame, DataFrame]:
    return logs.split_dirty(log_texts(t.event_rows()))


@query
def dirty_split(t: Tables) -> DataFrame:
    good, dirty = _logs(t)
    return union_all([good.select(F.lit("ok").alias("kind")), dirty.select(F.lit("dirty").alias("kind"))]).groupBy(
        "kind").agg(F.count(F.lit(1)).alias("n"))


@query
def log_split(t: Tables) -> DataFrame:
    """Records of each kind by day."""
    return fn.add_day(logs.log_kinds(_logs(t)[0]), "ts").groupBy("kind", "ds").agg(F.count(F.lit(1)).alias("n"))


@query
def display_normalize(t: Tables) -> DataFrame:
    return logs.normalize_display(logs.split_log(_logs(t)[0])["display"])


@query
def action_normalize(t: Tables) -> DataFrame:
    return logs.normalize_action(logs.split_log(_logs(t)[0])["action"])


@query
def is_new_fixed(t: Tables) -> DataFrame:
    """First-visit flag by device."""
    rows = t.event_rows().select("event_id", tag("m", "user_id").alias("mid"), F.unix_millis("ts").alias("ts"))
    return logs.fix_is_new(rows)


@query
def sensitive_flag(t: Tables) -> DataFrame:
    """Whole texts checked for a listed last word; the words are the last words of the benchmark texts."""
    def comma_words(text: str):
        return F.regexp_replace(F.col(text), r"\s+", ",")

    words = t.benchmark.select(F.element_at(F.split(comma_words("text"), ","), -1).alias("word")).distinct()
    texts = t.documents.select("doc_id", comma_words("text").alias("txt"))
    return logs.flag_sensitive(texts, "txt", words).drop("txt")


# ---- scalar functions


@query
def hash_bucket(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", fn.hash_mod(key, 128, RESERVED).alias("bucket"), fn.salted_key("user", key).alias("row_key"))


@query
def masking_suite(t: Tables) -> DataFrame:
    from tidewater.functions.masking import PHONE

    number = phone("c_custkey")
    return t.customer.select(
        "c_custkey", fn.mask_name(F.col("c_name")).alias("name"), fn.mask_phone(number).alias("short_phone"),
        fn.mask_phone(number, "middle").alias("middle_phone"), fn.anon(number, PHONE).alias("hashed_phone"),
        fn.mask_email(F.concat("c_mktsegment", F.lit("@x.org")), "middle").alias("email"))


@query
def scalar_suite(t: Tables) -> DataFrame:
    """Times, visitor ids, blanks, steps and values on every event."""
    e = t.event_rows()
    ms = F.unix_millis("ts")
    mixed = F.when(F.col("k") % 2 == 0, ms).otherwise(F.floor(ms / 1000))
    blank = F.when(F.col("k") % 5 == 0, " ").otherwise("x")
    return e.select(
        "event_id", fn.fmt_day(mixed).alias("day"), fn.ms_to_time(ms).alias("at"),
        fn.ms_to_date(ms).alias("date"), fn.duration_sec(ms, ms + F.col("k") * 700).alias("seconds"),
        fn.iso_trim(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso"),
        fn.event_ts(F.col("k") % 3, F.col("k") % 2, F.lit(9)).alias("picked"),
        fn.visitor_id(F.when(F.col("k") % 2 == 0, "null").otherwise("u1"), F.lit("m1")).alias("visitor"),
        fn.is_blank(blank).alias("blank"), fn.step_label(F.col("k"), F.col("event_type")).alias("step"),
        fn.last_token(F.concat_ws(",", F.lit("a"), "event_type", F.lit(""))).alias("last"),
        fn.ratio(F.col("k"), F.col("k") % 4).alias("part"))


@query
def day_partitions(t: Tables) -> DataFrame:
    """Every partition day between the first and last order, with its orders."""
    ends = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    first, last = ends.select(F.col("a").cast("string"), F.col("b").cast("string")).first()
    days = fn.day_range(t.spark, first, last)
    counts = t.orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"))
    return days.join(counts, "day", "left").select("day", F.coalesce("orders", F.lit(0)).alias("orders"))


@query
def session_steps(t: Tables) -> DataFrame:
    """Step number of every event of a user, cut into day slices so that a busy user is spread."""
    return step_index(t.event_rows(), ["user_id"], ["ts", "event_id"], "step", F.col("dt")).select(
        "event_id", "user_id", "step")


# ---- write paths, read back


@query
def report_history(t: Tables) -> DataFrame:
    """Two runs of a daily report merged into its history, then a day run again with the same rows."""
    path = work_dir(t.spark, "history")
    daily = t.event_rows().groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("n"))
    day = F.lit("2024-01-15").cast("date")
    merge_history(t.spark, path, daily.where(F.col("dt") <= day))
    merge_history(t.spark, path, daily.where(F.col("dt") >= day))
    return merge_history(t.spark, path, daily.where(F.col("dt") == day))


@query
def ingest_full_inc(t: Tables) -> DataFrame:
    """A full load under the run day and an incremental load by creation day, then one day loaded again."""
    full, inc = work_dir(t.spark, "full"), work_dir(t.spark, "inc")
    overwrite_partition(ingest_full(t.customer, ORDER_DAY), full)
    events = t.event_rows().select("event_id", "ts")
    overwrite_partition(ingest_inc(events, "ts"), inc)
    overwrite_partition(ingest_inc(events, "ts", EVENT_DAY), inc)
    loaded = [t.spark.read.parquet(p).select(F.lit(n).alias("load"), "dt") for n, p in (("full", full), ("inc", inc))]
    return union_all(loaded).groupBy("load", "dt").agg(F.count(F.lit(1)).alias("n"))


@query
def append_days(t: Tables) -> DataFrame:
    """Appending a day twice repeats its rows."""
    path = work_dir(t.spark, "append")
    rows = ingest_inc(t.event_rows().select("event_id", "ts"), "ts")
    append_partition(rows, path)
    append_partition(rows.where(F.col("dt") == F.lit(EVENT_DAY).cast("date")), path)
    return t.spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query
def day_bucket(t: Tables) -> DataFrame:
    """Events written by day; a time may be in seconds, in milliseconds or unusable."""
    ms = F.unix_millis("ts")
    stamp = F.when(F.col("k") % 10 == 0, "soon").when(F.col("k") % 2 == 0, ms.cast("string")).otherwise(
        F.floor(ms / 1000).cast("string"))
    path = work_dir(t.spark, "buckets")
    write_day_buckets(t.event_rows().select("event_id", stamp.alias("stamp")), "stamp", path)
    written = t.spark.read.schema("event_id bigint, stamp string, day string").json(path)
    return written.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query
def topic_files(t: Tables) -> DataFrame:
    """Rows sent to the topic their column names, in the file form of the sink."""
    path = work_dir(t.spark, "topics")
    rows = t.event_rows().select(tag("log_", "event_type").alias("topic"), "event_id", "user_id")
    write_events(rows, "parquet", {"path": path})
    sent = t.spark.read.parquet(path)
    ids = F.get_json_object("value", "$.event_id").cast("bigint")
    return sent.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.sum(ids).alias("ids"))


@query
def snapshot_upsert(t: Tables) -> DataFrame:
    """Customers, then changes from their orders: the newest row of each key replaces the stored one."""
    path = work_dir(t.spark, "snapshot")
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("level"), F.lit(0).cast("bigint").alias("version"))
    changes = t.orders.select(F.col("o_custkey").alias("id"), F.lit(None).cast("string").alias("name"),
                              F.col("o_orderpriority").alias("level"), F.col("o_orderkey").alias("version"))
    upsert_snapshot(t.spark, base, ["id"], ["version"], path, 0)
    upsert_snapshot(t.spark, changes, ["id"], ["version"], path, 1)
    return read_snapshot(t.spark, path)


@query
def snapshot_merge_columns(t: Tables) -> DataFrame:
    """The same with column-wise merging: a missing name keeps the stored one. The last batch is run twice."""
    path = work_dir(t.spark, "columns")
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("level"), F.lit(0).cast("bigint").alias("version"))
    changes = t.orders.select(F.col("o_custkey").alias("id"), F.lit(None).cast("string").alias("name"),
                              F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("level"),
                              F.col("o_orderkey").alias("version"))
    upsert_snapshot(t.spark, base, ["id"], ["version"], path, 0, skip_nulls=True)
    for _ in range(2):
        upsert_snapshot(t.spark, changes, ["id"], ["version"], path, 1, skip_nulls=True)
    return scan_snapshot(t.spark, path)


def _device_texts(t: Tables) -> DataFrame:
    """Device records as text lines; every 50th number gives a broken one."""
    k = F.col("k")
    record = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("log_id"),
        F.struct(tag("brand", k % 3).alias("brand"), tag("u", "user_id").alias("uname")).alias("device"),
        F.struct(tag("10.0.0.", k % 200).alias("ip")).alias("gis"), F.struct(F.lit("wifi").alias("net")).alias("network"),
        F.col("event_type").alias("opa"), F.col("value").alias("ts"), tag("p", k).alias("product_id"),
        F.array(tag("w", k % 5), tag("w", k % 7)).alias("keywords"), "dt"))
    return t.event_rows().select(F.when(k % 50 == 0, F.concat(F.lit("broken "), record)).otherwise(record).alias("value"), "dt")


@query
def device_load(t: Tables) -> DataFrame:
    """Device records from text files, published by day halves; the second load is repeated and must not count again."""
    source, path = work_dir(t.spark, "device-texts"), work_dir(t.spark, "devices")
    late = F.col("dt") >= F.lit("2024-01-15").cast("date")
    texts = _device_texts(t)
    for name, rows in (("early", texts.where(~late)), ("late", texts.where(late))):
        rows.select("value").write.text(f"{source}/{name}")
    schema = load_device_records(t.spark, f"{source}/early").schema
    for name in ("early", "late", "late"):
        publish(load_device_records(t.spark, f"{source}/{name}"), path, name, batch_size=2_000)
    rows = read_published(t.spark, path, schema)
    return rows.select("log_id", "brand", "uname", "ip", "net", "opa", "ts", "product_id", "keywords")


@query
def json_lines(t: Tables) -> DataFrame:
    """The same lines with a schema of their own; a line that does not parse keeps its text."""
    source = work_dir(t.spark, "json-lines")
    _device_texts(t).select("value").write.text(source)
    rows = read_json_lines(t.spark, source, "log_id string, opa string, ts double")
    return rows.select("log_id", "opa", "ts", F.substring("_corrupt_record", 1, 6).alias("broken"))
