"""Change envelopes and log records as JSON text, built from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtures.tables import tag

LETTERS = ["c", "u", "d", "r"]
ORDER_TABLES = ["order_info", "order_detail", "payment_info", "order_refund", "cart_info", "favor_info",
                "comment_info", "user_log"]


def pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def envelope(table: Column, op: Column, row: Column, ts_ms: Column, wrapped: Column | None = None) -> Column:
    """Envelope text; the row stands before a delete and after anything else. ``wrapped`` rows lie in payload."""
    body = F.struct(
        op.alias("op"), F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after"),
        F.struct(F.lit("shop").alias("db"), table.alias("table"), F.lit("1").alias("server_id"),
                 F.when(op == "r", "true").otherwise("false").alias("snapshot")).alias("source"),
        ts_ms.alias("ts_ms"))
    plain = F.to_json(body)
    return plain if wrapped is None else F.when(wrapped, F.to_json(F.struct(body.alias("payload")))).otherwise(plain)


def order_changes(orders: DataFrame) -> DataFrame:
    """One change per order: the table, operation and nesting follow from the key; every 50th text is broken."""
    key = F.col("o_orderkey")
    row = F.struct(key.alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status"),
                   F.col("o_totalprice").alias("total_amount"))
    ts_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + key % 86400000
    text = envelope(pick(ORDER_TABLES, key), pick(LETTERS, F.floor(key / 8)), row, ts_ms, key % 3 == 0)
    return orders.select(F.when(key % 50 == 0, F.concat(F.lit("broken "), key.cast("string"))).otherwise(text).alias("value"))


def ods_changes(orders: DataFrame) -> DataFrame:
    """Changes of the tables of the second source layer, with their key columns."""
    names = ["ods_user_info", "ods_order_info", "ods_order_detail", "ods_pay_detail", "ods_refund_info", "ods_other"]
    key = F.col("o_orderkey")
    row = F.struct(*[key.alias(c) for c in ("user_id", "order_id", "order_detail_id", "pay_id", "refund_id")])
    ts_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return orders.select(
        envelope(pick(names, key), pick(LETTERS, F.floor(key / 6)), row, ts_ms, key % 3 == 0).alias("value"))


def customer_changes(customer: DataFrame) -> DataFrame:
    row = F.struct("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    op = F.when(F.col("c_custkey") % 10 == 0, "d").otherwise("c")
    return customer.select(envelope(F.lit("customer"), op, row, F.col("c_custkey")).alias("value"))


def log_texts(events: DataFrame) -> DataFrame:
    """Log records: views show skus, clicks act on them, signups start the app, errors carry an error, purchases
    are plain pages. A record with a number divisible by 50 is broken."""
    k, user, kind = F.col("k"), F.col("user_id"), F.col("event_type")
    sku = k.cast("string")

    def when(name: str, value: Column) -> Column:
        return F.when(kind == name, value)

    uid = F.when(user % 3 == 0, "null").when(user % 3 == 1, "").otherwise(tag("u", user))
    record = F.struct(
        F.struct(tag("m", user).alias("mid"), uid.alias("uid"), F.concat_ws("-", "user_id", "dt").alias("sid"),
                 F.lit("1").alias("is_new")).alias("common"),
        F.when(kind != "signup", F.struct(tag("p", k % 6).alias("page_id"),
                                          F.floor(F.col("value") * 1000).cast("bigint").alias("during_time"))).alias("page"),
        when("view", F.array(F.struct(sku.alias("item"), F.lit("SKU_ID").alias("item_type")),
                             F.struct(F.lit("b1").alias("item"), F.lit("banner").alias("item_type")))).alias("displays"),
        when("click", F.array(F.struct(pick(["CLICK", "favor_add", "cart_add", "other"], k).alias("action_id"),
                                       sku.alias("item"), F.lit("sku_id").alias("item_type")))).alias("actions"),
        when("signup", F.struct(F.lit("icon").alias("entry"))).alias("start"),
        when("error", F.struct(k.alias("code"))).alias("err"),
        F.unix_millis("ts").alias("ts"))
    text = F.when(k % 50 == 0, F.concat(F.lit('{"bad '), sku)).otherwise(F.to_json(record))
    return events.select(text.alias("value"))
