"""Application logs: validity, splitting, normalising, first-visit flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import parsed_once, visitor_id
from tidewater.operators.joins import attach

# Layout of a log record.
LOG = """
    common struct<mid:string,uid:string,sid:string,is_new:string>,
    page struct<page_id:string,during_time:bigint>,
    displays array<struct<item:string,item_type:string>>,
    actions array<struct<action_id:string,item:string,item_type:string,sku_id:string,ts:bigint>>,
    display struct<item:string,item_type:string>,
    action struct<action_id:string,item:string,item_type:string,sku_id:string,ts:bigint>,
    start string, err string, ts bigint,
    item string, item_type string, sku_id string, action_id string, uid string, mid string, sid string,
    _corrupt_record string
"""

# Actions that count, by the metric they feed.
ACTION_METRIC = {
    "click": "click",
    "good_click": "click",
    "good_detail_click": "click",
    "favor_add": "favor",
    "cart_add": "cart",
}


def split_dirty(df: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed records, and the texts that are not JSON objects."""
    parsed = df.select(F.col(column).alias("value"), parsed_once(F.from_json(column, LOG)).alias("log"))
    bad = F.col("log").isNull() | F.col("log._corrupt_record").isNotNull()
    return parsed.where(~bad).select("log.*").drop("_corrupt_record"), parsed.where(bad).select("value")


def split_log(logs: DataFrame) -> dict[str, DataFrame]:
    """Errors, starts, displays, actions and pages. Displays and actions keep the time of their record."""
    pages = logs.where(F.col("start").isNull())
    context = ["common", "page", "ts"]
    return {
        "err": logs.where(F.col("err").isNotNull()).select("err", "ts"),
        "start": logs.where(F.col("start").isNotNull()).select("common", "start", "ts"),
        "display": pages.select(*context, F.explode("displays").alias("display")),
        "action": pages.select(*context, F.explode("actions").alias("action")),
        "page": pages.select(*context),
    }


def log_kinds(logs: DataFrame) -> DataFrame:
    """One row per output of :func:`split_log`, by kind and time: the same split as a single pass, for counting."""
    def kind(name: str, times: Column) -> Column:
        return F.array_repeat(F.lit(name), F.coalesce(times, F.lit(0)).cast("int"))

    started = F.col("start").isNotNull()
    page = F.concat(kind("display", F.size("displays")), kind("action", F.size("actions")), kind("page", F.lit(1)))
    kinds = F.concat(kind("err", F.col("err").isNotNull().cast("int")),
                     F.when(started, kind("start", F.lit(1))).otherwise(page))
    return logs.select("ts", F.explode(kinds).alias("kind"))


def visitor(df: DataFrame) -> Column:
    """Account or device of a record, wherever the record keeps it."""
    top = [F.col(c) for c in ("uid", "mid") if c in df.columns]
    return visitor_id(F.col("common.uid"), F.col("common.mid"), *top)


def _text(c: Column) -> Column:
    return F.when(c != "", c)


def _field(df: DataFrame, name: str) -> Column:
    return _text(F.col(name)) if name in df.columns else F.lit(None).cast("string")


def normalize_display(df: DataFrame) -> DataFrame:
    """Displays of skus with ``sku_id`` and ``visitor``; the sku may be nested, flat or only in ``sku_id``."""
    item = F.coalesce(_text(F.col("display.item")), _field(df, "item"))
    kind = F.coalesce(_text(F.col("display.item_type")), _field(df, "item_type"))
    only_sku = item.isNull() & _field(df, "sku_id").isNotNull()
    rows = df.select(
        "ts", visitor(df).alias("visitor"),
        F.coalesce(item, _field(df, "sku_id")).alias("sku_id"),
        F.when(only_sku, "sku_id").otherwise(F.lower(kind)).alias("__kind"))
    return rows.where((F.col("__kind") == "sku_id") & F.col("sku_id").isNotNull()).drop("__kind")


def normalize_action(df: DataFrame) -> DataFrame:
    """Actions on skus with ``metric`` (click, favor, cart), ``sku_id`` and ``visitor``.

    An action may be an element of ``actions``, the object ``action`` or the record itself; its own time wins over
    the time of the record.
    """
    nothing = F.lit(None).cast("array<struct<action_id:string,item:string,item_type:string,sku_id:string,ts:bigint>>")
    many = F.when(F.size("actions") > 0, F.col("actions")) if "actions" in df.columns else nothing
    one = F.when(F.col("action").isNotNull(), F.array("action")) if "action" in df.columns else nothing
    flat = F.array(F.struct(
        _field(df, "action_id").alias("action_id"), F.lit(None).cast("string").alias("item"),
        F.lit(None).cast("string").alias("item_type"), F.lit(None).cast("string").alias("sku_id"),
        F.lit(None).cast("bigint").alias("ts")))
    each = df.withColumn("__v", visitor(df)).withColumn("__a", F.explode(F.coalesce(many, one, flat)))
    item = F.coalesce(_text(F.col("__a.item")), _field(df, "item"))
    kind = F.coalesce(_text(F.col("__a.item_type")), _field(df, "item_type"))
    sku = F.coalesce(_text(F.col("__a.sku_id")), _field(df, "sku_id"))
    metrics = F.create_map(*[F.lit(x) for pair in ACTION_METRIC.items() for x in pair])
    own_ts = F.when(F.col("__a.ts") != 0, F.col("__a.ts"))
    rows = each.select(
        F.coalesce(own_ts, F.col("ts")).alias("ts"), F.col("__v").alias("visitor"),
        F.coalesce(item, sku).alias("sku_id"),
        F.when(item.isNull() & sku.isNotNull(), "sku_id").otherwise(F.lower(kind)).alias("__kind"),
        F.try_element_at(metrics, F.lower(F.col("__a.action_id"))).alias("metric"))
    keep = (F.col("__kind") == "sku_id") & F.col("sku_id").isNotNull() & F.col("metric").isNotNull()
    return rows.where(keep).drop("__kind")


def fix_is_new(logs: DataFrame, device: str = "mid", ts: str = "ts", out: str = "is_new") -> DataFrame:
    """``1`` exactly on the device's first day.

    The first day is an aggregate per device joined back, not a window, so a device with very many records is
    reduced before the shuffle and its records are split by AQE in the join.
    """
    day = F.to_date(F.timestamp_millis(F.col(ts)))
    first = logs.groupBy(device).agg(F.min(day).alias("__first"))
    marked = attach(logs, first, {device: device}, {"__first": "__first"})
    return marked.withColumn(out, F.when(day == F.col("__first"), "1").otherwise("0")).drop("__first")


def flag_sensitive(df: DataFrame, text: str, words: DataFrame, word: str = "word") -> DataFrame:
    """Mark rows whose last comma-separated part is a listed word; grade ``P0`` names the word."""
    from tidewater.functions import last_token

    checked = df.withColumn("__last", last_token(F.col(text)))
    listed = words.select(F.col(word)).where(F.col(word) != "").distinct()
    hit = attach(checked, listed, {"__last": word}, {"__hit": word})
    found = F.col("__hit").isNotNull()
    return hit.withColumns({
        "is_violation": F.when(found, 1).otherwise(0),
        "violation_grade": F.when(found, "P0").otherwise(""),
        "violation_msg": F.when(found, F.col("__hit")).otherwise(""),
    }).drop("__last", "__hit")
