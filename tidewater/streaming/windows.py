"""Windowed statistics, the same code for batch and streams.

Distinct users are counted in two levels: first per window, key and user, then per window and key. State and
shuffle so spread over the users of a hot key, and no set of users is ever held in one row. Both levels are
aggregates, so a stream runs them in append mode and emits a window once the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import money
from tidewater.operators.sets import union_streams


def window_stats(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    entity: str,
    measures: Mapping[str, Column],
    entities: Mapping[str, str],
    null_entity_counts: bool = False,
) -> DataFrame:
    """Sums and distinct entities per tumbling window and key.

    ``measures`` are per-row values to add up; ``entities`` names distinct counts and the measure that must be
    positive for an entity to count. ``stt`` and ``edt`` are the window bounds in epoch milliseconds. For a window
    over arrival instead of event time, pass a column stamped at the read.
    """
    per_entity = df.groupBy(F.window(ts, size).alias("window"), *keys, entity).agg(
        *[F.sum(value).alias(f"__m_{name}") for name, value in measures.items()])

    def counted(measure: str) -> Column:
        inside = F.col(f"__m_{measure}") > 0
        return F.count(F.when(inside if null_entity_counts else inside & F.col(entity).isNotNull(), 1))

    stats = per_entity.groupBy("window", *keys).agg(
        *[F.sum(f"__m_{name}").alias(name) for name in measures],
        *[counted(measure).alias(name) for name, measure in entities.items()])
    return stats.select(
        F.unix_millis("window.start").alias("stt"), F.unix_millis("window.end").alias("edt"), *keys,
        *measures, *entities)


def _one() -> Column:
    return F.lit(1).cast("bigint")


def order_stats(details: DataFrame, ts: str = "event_ts", minutes: int = 1) -> DataFrame:
    """Order lines per sku; ``order_ct`` counts lines. The amount is the line total, else price times number."""
    amount = F.coalesce(money(F.col("split_total_amount")), money(F.col("order_price") * F.col("sku_num")), F.lit(0))
    return window_stats(
        details, ts, f"{minutes} minutes", ["sku_id"], "user_id",
        {"order_ct": _one(), "sku_num": F.coalesce("sku_num", F.lit(0)), "order_amount": amount},
        {"order_user_ct": "order_ct"})


def payment_stats(paid: DataFrame, ts: str = "event_ts", minutes: int = 1) -> DataFrame:
    return window_stats(
        paid, ts, f"{minutes} minutes", ["sku_id"], "user_id",
        {"payment_ct": _one(), "payment_amount": money(F.coalesce("payment_amount", F.lit(0)))},
        {"payment_user_ct": "payment_ct"})


def refund_stats(refunded: DataFrame, ts: str = "event_ts", minutes: int = 1) -> DataFrame:
    return window_stats(
        refunded, ts, f"{minutes} minutes", ["sku_id"], "user_id",
        {"refund_ct": _one(), "refund_amount": money(F.coalesce("refund_amount", F.lit(0)))},
        {"refund_user_ct": "refund_ct"})


METRICS = ("exposure", "click", "favor", "cart")


def action_stats(displays: DataFrame, actions: DataFrame, ts: str = "event_ts", minutes: int = 1) -> DataFrame:
    """Exposures, clicks, favourites and cart adds per sku, from normalised displays and actions.

    Both go through one aggregate instead of two that are merged later.
    """
    shown = displays.select(ts, "sku_id", "visitor", F.lit("exposure").alias("metric"))
    rows = shown.unionByName(actions.select(ts, "sku_id", "visitor", "metric"))
    ones = {f"{m}_ct": F.when(F.col("metric") == m, 1).otherwise(0).cast("bigint") for m in METRICS}
    return window_stats(rows, ts, f"{minutes} minutes", ["sku_id"], "visitor", ones,
                        {f"{m}_user_ct": f"{m}_ct" for m in METRICS}, null_entity_counts=True)


def visit_stats(pages: DataFrame, starts: DataFrame, ts: str = "event_ts", minutes: int = 1) -> DataFrame:
    """Page views, visitors, stay, bounced and started sessions of all traffic.

    ``pages`` has visitor, sid and during_time, ``starts`` has sid. Each page counts once for its visitor and once
    for its session; the first level groups by these ids, the second only adds up.
    """
    facets = F.array(
        F.struct(F.lit("visitor").alias("kind"), F.col("visitor").alias("id"),
                 F.coalesce("during_time", F.lit(0)).cast("bigint").alias("stay")),
        F.struct(F.lit("session").alias("kind"), F.col("sid").alias("id"), F.lit(0).cast("bigint").alias("stay")))
    viewed = pages.select(ts, F.inline(facets))
    started = starts.select(ts, F.lit("start").alias("kind"), F.col("sid").alias("id"),
                            F.lit(0).cast("bigint").alias("stay"))
    per_id = viewed.unionByName(started).groupBy(F.window(ts, f"{minutes} minutes").alias("window"), "kind", "id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("stay").alias("stay"))
    kind, named = F.col("kind"), F.col("id").isNotNull() & (F.col("id") != "")
    stats = per_id.groupBy("window").agg(
        F.sum(F.when(kind == "visitor", F.col("n")).otherwise(0)).alias("pv"),
        F.count(F.when(kind == "visitor", 1)).alias("uv"),
        F.sum("stay").alias("duration_ms"),
        F.count(F.when((kind == "session") & named & (F.col("n") == 1), 1)).alias("bounce_ct"),
        F.count(F.when((kind == "start") & named, 1)).alias("session_ct"))
    return stats.select(F.unix_millis("window.start").alias("stt"), F.unix_millis("window.end").alias("edt"),
                        "pv", "uv", "duration_ms", "bounce_ct", "session_ct")


def daily_totals(
    frames: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str], utc_offset_hours: int = 0,
    ttl: str = "3 days",
) -> DataFrame:
    """Running totals per day and key over window rows of several sources (columns ``stt``, keys, measures).

    The day is that of the window start in the business zone. A stream runs this in update mode: each trigger
    emits the whole current total of the keys that changed, to be written over the earlier one by (dt, key), so a
    day that fires often never counts twice. State is dropped ``ttl`` after the day.
    """
    rows = union_streams([f.select("stt", *keys, *[c for c in f.columns if c in measures]) for f in frames])
    timed = rows.withColumn("__ts", F.timestamp_millis("stt")).withWatermark("__ts", ttl)
    shift = (24 - utc_offset_hours) % 24
    day = F.window("__ts", "1 day", "1 day", f"{shift} hours").alias("window")
    totals = timed.groupBy(day, *keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    dt = F.to_date(F.col("window.start") + F.expr(f"INTERVAL {utc_offset_hours} HOURS"))
    return totals.select(dt.alias("dt"), *keys, *measures)
