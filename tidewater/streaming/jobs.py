"""Streaming warehouse jobs: each takes its input frames and returns its outputs by name.

The frames may be batch frames too, for backfills. Writing is left to the caller (``run.start``, ``run.fan_out``,
``sinks.write_events``, ``sinks.snapshot_writer``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import add_day, money
from tidewater.operators import cdc, logs
from tidewater.operators.joins import attach
from tidewater.sinks.snapshot import read_snapshot, upsert_cells, upsert_snapshot
from tidewater.sinks.writers import apply_dim_config
from tidewater.streaming.lateness import Input, sorting_sink
from tidewater.streaming.times import interval_join, with_event_time
from tidewater.streaming.windows import (
    action_stats,
    daily_totals,
    order_stats,
    payment_stats,
    refund_stats,
    visit_stats,
)

Frames = dict[str, DataFrame]
HOUR = 3600


def dim_bus(streams: Frames, config: DataFrame) -> Frames:
    """Changes to dimension rows and a copy of every change for the topic."""
    envelopes = cdc.parse_envelope(streams["cdc"])
    return {"raw": streams["cdc"].select("value"), "dims": cdc.route_by_config(envelopes, config)}


def dim_bus_sink(config: Callable[[], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink that routes by the configuration as it is now and merges the rows by key."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = cdc.route_by_config(cdc.parse_envelope(batch), config())
        upsert_snapshot(batch.sparkSession, rows, ["sink_table", "row_key"], ["ts_ms"], path, batch_id)

    return sink


#: Source table whose changes are the configuration of the dimension bus.
CONFIG_TABLE = "table_process_dim"


def config_bus_sink(
    config_path: str, path: str, config_table: str = CONFIG_TABLE, database: str | None = None,
    schema_of: Callable[[str], str] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink for a change bus that carries the configuration's changes beside those of the dimension tables.

    Changes of the configuration are kept under ``config_path``; the rows of a batch are routed by the version that held at
    their own time, so the order of rows within a batch, or of batches, does not decide. A change must not come later than
    the batch of the first row that needs it. With a ``database``, target tables are created and dropped as the changes say.
    Rows of one target and key are merged under ``path``, the newest by time stays.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, envelopes = batch.sparkSession, cdc.parse_envelope(batch).persist()
        try:
            is_config = F.coalesce(F.col("source.table") == config_table, F.lit(False))
            changes = cdc.clean_config_cdc(envelopes.where(is_config))
            entries = [F.to_json(c) for c in ("before", "after")]
            kept = changes.withColumn("change", F.md5(F.concat_ws("|", "op", F.col("ts_ms").cast("string"), *entries)))
            upsert_snapshot(spark, kept, ["change"], ["ts_ms"], config_path, batch_id, buckets=1)
            if database is not None:
                apply_dim_config(spark, changes, schema_of, database)
            rows = cdc.route_by_versions(envelopes.where(~is_config), cdc.config_versions(read_snapshot(spark, config_path)))
            upsert_snapshot(spark, rows, ["sink_table", "row_key"], ["ts_ms"], path, batch_id, last_batch_wins=False)
        finally:
            envelopes.unpersist()

    return sink


def comment_bus(streams: Frames, dictionary: DataFrame, order_schema: str, delay: str = "3 seconds") -> Frames:
    """Comments with the name of their grade and the order they belong to."""
    envelopes = cdc.parse_envelope(streams["cdc"])
    comments = cdc.lookup_dim(cdc.comment_fact(envelopes), dictionary, "appraise", "dic_code", "dic_name", "dic_name")
    orders = cdc.order_fact(envelopes, order_schema)
    joined = interval_join(
        with_event_time(comments, "ts_ms", delay), with_event_time(orders, "tm_ms", delay), ("order_id", "id"),
        ("event_ts", "event_ts"), -60, 60, prefix="info_")
    return {"comments": add_day(joined, "ts_ms").drop("event_ts", "info_event_ts")}


def log_bus(streams: Frames) -> Frames:
    """Typed log outputs by kind, and the dirty texts, of one bounded frame. A stream takes :func:`log_bus_sink`, which
    knows the devices of earlier micro-batches."""
    good, dirty = logs.split_dirty(streams["log"])
    return {**_log_parts(logs.fix_is_new(_with_device(good), device="mid_key", out="__new")), "dirty": dirty}


def _with_device(good: DataFrame) -> DataFrame:
    return good.withColumn("mid_key", F.col("common.mid"))


def _log_parts(flagged: DataFrame) -> Frames:
    fixed = flagged.withColumn("common", F.col("common").withField("is_new", F.col("__new"))).drop("__new", "mid_key")
    return logs.split_log(fixed)


def log_bus_sink(
    first_days: str, write: Callable[[str, DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink of the log bus: parses the batch once, corrects the first-visit flag by the days kept under
    ``first_days`` and hands each output to ``write``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        good, dirty = logs.split_dirty(batch)

        def split(flagged: DataFrame, _: int) -> None:
            flagged.persist()
            try:
                for name, rows in _log_parts(flagged).items():
                    write(name, rows, batch_id)
            finally:
                flagged.unpersist()

        first_visit_sink(first_days, split, device="mid_key", out="__new")(_with_device(good), batch_id)
        write("dirty", dirty, batch_id)

    return sink


def first_visit_sink(
    path: str, write: Callable[[DataFrame, int], None], device: str = "mid", ts: str = "ts", out: str = "is_new"
) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink that keeps the first day of every device and hands rows with their first-visit flag on.

    Only one reduced row per device and batch is merged into the stored first days; the rows themselves meet it in
    a join, which AQE splits for a device with very many rows.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date(F.timestamp_millis(F.col(ts)))
        first = batch.groupBy(device).agg(F.min(day).alias("first_day"))
        order = first.withColumn("__early", -F.datediff("first_day", F.lit("1970-01-01").cast("date")))
        known = upsert_snapshot(batch.sparkSession, order, [device], ["__early"], path, batch_id,
                                last_batch_wins=False)
        marked = attach(batch, known, {device: device}, {"__first": "first_day"})
        write(marked.withColumn(out, F.when(day == F.col("__first"), "1").otherwise("0")).drop("__first"), batch_id)

    return sink


def db_rows(batch: DataFrame) -> DataFrame:
    """The changes of a batch, parsed; a sink with several outputs takes them so that texts are parsed once."""
    return cdc.normalize_cdc(cdc.parse_envelope(batch))


def db_router(streams: Frames) -> Frames:
    return cdc.route_by_table(db_rows(streams["cdc"]))


def order_window(streams: Frames, minutes: int = 1, delay: str = "3 seconds") -> Frames:
    details = with_event_time(streams["order_detail"], "event_time", delay)
    return {"order_stats": order_stats(details, minutes=minutes)}


def paid_lines(streams: Frames, hours: int = 2, delay: str = "3 seconds", allocate: str = "order") -> DataFrame:
    """Payments brought to sku lines. By default the order total stands on each line; ``allocate="line"`` takes
    the line's own amount."""
    pay = with_event_time(streams["payment"], "event_time", delay)
    lines = with_event_time(streams["order_detail"], "event_time", delay)
    pairs = interval_join(pay, lines, ("order_id", "order_id"), ("event_ts", "event_ts"), -hours * HOUR,
                          hours * HOUR, prefix="d_")
    amount = F.col("total_amount") if allocate == "order" else F.col("d_split_total_amount")
    return pairs.select("event_ts", F.col("d_sku_id").alias("sku_id"), "user_id",
                        money(amount).alias("payment_amount"))


def refunded_lines(streams: Frames, hours: int = 2, delay: str = "3 seconds") -> DataFrame:
    refund = with_event_time(streams["refund"], "event_time", delay)
    lines = with_event_time(streams["order_detail"], "event_time", delay)
    pairs = interval_join(refund, lines, ("order_id", "order_id"), ("event_ts", "event_ts"), -hours * HOUR,
                          hours * HOUR, prefix="d_")
    return pairs.select("event_ts", F.col("d_sku_id").alias("sku_id"), "user_id",
                        money(F.col("refund_amount")).alias("refund_amount"))


def payment_window(streams: Frames, minutes: int = 1, **options) -> Frames:
    return {"payment_stats": payment_stats(paid_lines(streams, **options), minutes=minutes)}


def refund_window(streams: Frames, minutes: int = 1, **options) -> Frames:
    """Nothing when there is no refund stream."""
    if "refund" not in streams:
        return {}
    return {"refund_stats": refund_stats(refunded_lines(streams, **options), minutes=minutes)}


def action_rows(streams: Frames) -> Frames:
    """Displays and actions as they enter the window; an action's own time decides."""
    return {"display": logs.normalize_display(streams["display"]), "action": logs.normalize_action(streams["action"])}


def action_window(streams: Frames, minutes: int = 1, delay: str = "5 seconds", normal: bool = False) -> Frames:
    """``normal``: the streams are those of :func:`action_rows` already."""
    rows = streams if normal else action_rows(streams)
    displays, actions = (with_event_time(rows[n], "ts", delay) for n in ("display", "action"))
    return {"action_stats": action_stats(displays, actions, minutes=minutes)}


def visit_rows(streams: Frames) -> Frames:
    """Pages and starts as they enter the window."""
    page = streams["page"]
    pages = page.select("ts", logs.visitor(page).alias("visitor"), F.col("common.sid").alias("sid"),
                        F.col("page.during_time").alias("during_time"))
    return {"page": pages, "start": streams["start"].select("ts", F.col("common.sid").alias("sid"))}


def visit_window(streams: Frames, minutes: int = 1, delay: str = "5 seconds", normal: bool = False) -> Frames:
    """``normal``: the streams are those of :func:`visit_rows` already."""
    rows = streams if normal else visit_rows(streams)
    pages, starts = (with_event_time(rows[n], "ts", delay) for n in ("page", "start"))
    return {"visit_stats": visit_stats(pages, starts, minutes=minutes)}


MINUTE_MS = 60_000
#: The inputs of the windowed jobs, as they enter the window or join.
INPUTS = {
    "order_window": {"order_detail": Input(["event_time"], 3000)},
    "payment_window": {"payment": Input(["event_time"], 3000), "order_detail": Input(["event_time"], 3000)},
    "refund_window": {"refund": Input(["event_time"], 3000), "order_detail": Input(["event_time"], 3000)},
    "action_window": {"display": Input(["ts"], 5000), "action": Input(["ts"], 5000)},
    "visit_window": {"page": Input(["ts"], 5000), "start": Input(["ts"], 5000)},
}


def sorted_inputs(
    job: str, folder: str, write: Callable[[str, DataFrame, int], None], minutes: int = 1, idle_seconds: int | None = None
) -> Callable[[DataFrame, int], None]:
    """The sorting sink before a windowed job: late and dirty rows become outputs, a silent input gets heartbeats.

    Its stream is ``lateness.gather`` of the job's inputs, those of :func:`action_rows` and :func:`visit_rows` for these two; the
    job then reads what was written under the names of its inputs, with ``normal=True``.
    """
    joined = job in ("payment_window", "refund_window")
    return sorting_sink(INPUTS[job], folder, write, 0 if joined else minutes * MINUTE_MS,
                        None if idle_seconds is None else idle_seconds * 1000)


ORDER = ["order_ct", "order_user_ct", "sku_num", "order_amount"]
PAYMENT = ["payment_ct", "payment_user_ct", "payment_amount"]
REFUND = ["refund_ct", "refund_user_ct", "refund_amount"]
FUNNEL = ["exposure_ct", "click_ct", "cart_ct", "favor_ct", "order_user_ct", "payment_user_ct"]
ACTION = [f"{m}_{k}" for m in ("exposure", "click", "favor", "cart") for k in ("ct", "user_ct")]
VISIT = ["pv", "uv", "duration_ms", "bounce_ct", "session_ct"]


def _present(streams: Frames, *names: str) -> list[DataFrame]:
    return [streams[n] for n in names if n in streams]


def funnel_daily(streams: Frames, **options) -> Frames:
    frames = _present(streams, "action_stats", "order_stats", "payment_stats")
    return {"ads_marketing_funnel_day": daily_totals(frames, ["sku_id"], FUNNEL, **options)}


def trade_sku_daily(streams: Frames, **options) -> Frames:
    frames = _present(streams, "order_stats", "payment_stats", "refund_stats")
    measures = [m for m in ORDER + PAYMENT + REFUND if any(m in f.columns for f in frames)]
    return {"ads_trade_sku_day": daily_totals(frames, ["sku_id"], measures, **options)}


def trade_overview_daily(streams: Frames, **options) -> Frames:
    frames = _present(streams, "order_stats", "payment_stats", "refund_stats")
    measures = [m for m in ORDER + PAYMENT + REFUND if any(m in f.columns for f in frames)]
    totals = daily_totals(frames, [], measures, **options)
    if "payment_amount" in measures:
        per_payer = F.try_divide(F.col("payment_amount").cast("double"), F.col("payment_user_ct"))
        totals = totals.withColumn("arp", F.coalesce(per_payer, F.lit(0.0)))
    return {"ads_trade_overview_day": totals}


def action_sku_daily(streams: Frames, **options) -> Frames:
    return {"ads_user_action_sku_day": daily_totals([streams["action_stats"]], ["sku_id"], ACTION, **options)}


def visit_daily(streams: Frames, **options) -> Frames:
    return {"ads_user_visit_day": daily_totals([streams["visit_stats"]], [], VISIT, **options)}


def ods_bootstrap(streams: Frames) -> Frames:
    """Raw and extracted changes with their topics, and behaviour logs as they come."""
    envelopes = cdc.parse_envelope(streams["cdc"])
    raw = envelopes.select(cdc.ods_topic(F.col("source.table"), raw=True).alias("topic"), "value")
    after = cdc.extract_after(envelopes)
    out = {"raw": raw, "after": after.withColumn("topic", cdc.ods_topic(F.col("__table"), raw=False))}
    if "behavior" in streams:
        out["behavior"] = streams["behavior"].withColumn("topic", F.lit("ods_behavior_log"))
    return out


def dwd_base(streams: Frames) -> Frames:
    """Extracted rows with their day and target topic."""
    return {"dwd": streams["ods"].withColumn("topic", cdc.dwd_topic(F.col("__table")))}


def user_dim_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink for the user dimension: one row per user, whose cells are merged one by one; nulls overwrite
    nothing."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        good, _ = cdc.user_dim_rows(batch)
        upsert_cells(batch.sparkSession, good, "row_key", "columns", "ts_ms", path, batch_id)

    return sink


def moderation(streams: Frames, words: DataFrame) -> Frames:
    """Comments checked against the word list."""
    flagged = logs.flag_sensitive(streams["comments"], "commentTxt", words)
    return {"checked": flagged.select(
        "user_id", F.col("info_consignee").alias("consignee"), "ts_ms", "ds", F.col("commentTxt").alias("msg"),
        "is_violation", "violation_grade", "violation_msg")}
