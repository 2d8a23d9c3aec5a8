"""Change envelopes to typed rows and topics. Works on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql import types as T

from tidewater.functions import add_day, is_blank, parsed_once, salted_key
from tidewater.operators.joins import attach

# Layout of a change envelope; the payload is kept as text by column name.
BODY = """op string, before map<string,string>, after map<string,string>,
          source struct<db string, `table` string, server_id string, snapshot string>, ts_ms bigint"""
ENVELOPE = f"{BODY}, payload struct<{BODY}>"

# Key column of each captured table.
TABLE_KEYS = {
    "ods_user_info": "user_id",
    "ods_store_info": "store_id",
    "ods_sku_info": "sku_id",
    "ods_order_info": "order_id",
    "ods_order_detail": "order_detail_id",
    "ods_pay_detail": "pay_id",
    "ods_refund_info": "refund_id",
    "ods_user_profile_snapshot": "snapshot_id",
}

# Fact stream of each source table, and the tables of which only inserts count.
FACT_STREAMS = {
    "order_info": "order_info",
    "order_detail": "order_detail",
    "payment_info": "payment_info",
    "order_refund": "refund_info",
    "cart_info": "cart_add",
    "favor_info": "favor_add",
    "comment_info": "comment_info",
}
INSERT_ONLY = ("cart_info", "favor_info")

# Tables with a topic of their own; all others are behaviour logs.
DWD_TABLES = ("user_info", "order_info", "order_detail", "pay_detail", "refund_info")


def parse_envelope(df: DataFrame, column: str = "value") -> DataFrame:
    """Envelope fields from JSON text, also when the envelope is wrapped in ``payload``. The text stays in
    ``value``; a text that is not an envelope gives nulls."""
    parsed = df.select(F.col(column).alias("value"), parsed_once(F.from_json(column, ENVELOPE)).alias("e"))
    wrapped = F.col("e.after").isNull() & F.col("e.op").isNull()

    def field(name: str) -> Column:
        return F.when(wrapped, F.col(f"e.payload.{name}")).otherwise(F.col(f"e.{name}")).alias(name)

    return parsed.select("value", *[field(n) for n in ("op", "before", "after", "source", "ts_ms")])


def normalize_cdc(envelopes: DataFrame) -> DataFrame:
    """Payload (the row before a delete, else the row after), table, operation and event time.

    A snapshot read counts as an insert. Rows without an operation did not parse and are left out.
    """
    return envelopes.where(F.col("op").isNotNull()).select(
        F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")).alias("payload"),
        F.col("source.table").alias("_table"),
        F.when(F.col("op") == "r", "c").otherwise(F.col("op")).alias("op"),
        F.col("ts_ms").alias("event_time"),
    )


def fact_stream(table: Column, op: Column) -> Column:
    """Name of the fact stream a normalised row belongs to, or null."""
    name = F.lit(None).cast("string")
    for source, target in FACT_STREAMS.items():
        match = table == source
        if source in INSERT_ONLY:
            match = match & (op == "c")
        name = F.when(match, F.lit(target)).otherwise(name)
    return name


def route_by_table(normalized: DataFrame) -> dict[str, DataFrame]:
    """The seven fact streams by name."""
    routed = normalized.withColumn("__stream", fact_stream(F.col("_table"), F.col("op")))
    return {
        name: routed.where(F.col("__stream") == name).drop("__stream", "_table") for name in FACT_STREAMS.values()
    }


def typed_payload(df: DataFrame, schema: T.StructType | str, column: str = "payload", keep=()) -> DataFrame:
    """Columns of a payload map, cast to the given types; a value that does not fit becomes null."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(
        *[F.try_element_at(F.col(column), F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in fields], *keep)


def extract_after(envelopes: DataFrame, keys: Mapping[str, str] = TABLE_KEYS) -> DataFrame:
    """Rows after the change, without deletes, with operation, table, key value and event time.

    ``dt`` is the day of the change, not of the run.
    """
    table = F.col("source.table")
    key_names = F.create_map(*[F.lit(x) for pair in keys.items() for x in pair])
    kept = envelopes.where(F.col("op").isNotNull() & (F.lower("op") != "d") & F.col("after").isNotNull())
    return kept.select(
        "after",
        F.col("op").alias("__op"),
        table.alias("__table"),
        F.try_element_at(F.col("after"), F.try_element_at(key_names, table)).alias("__pk"),
        "ts_ms",
        F.to_date(F.timestamp_millis("ts_ms")).alias("dt"),
    )


def ods_topic(table: Column, raw: bool) -> Column:
    name = F.concat(F.lit("ods_mysql_"), F.coalesce(table, F.lit("unknown")))
    return F.concat(name, F.lit("_raw")) if raw else name


def dwd_topic(table: Column) -> Column:
    """Target topic; the prefix the source layer puts before table names does not count."""
    bare = F.regexp_replace(table, "^ods_", "")
    return (
        F.when(table.isNull(), "dwd_unknown")
        .when(bare.isin(*DWD_TABLES), F.concat(F.lit("dwd_"), bare))
        .otherwise("dwd_behavior_log")
    )


def clean_config_cdc(envelopes: DataFrame) -> DataFrame:
    """Configuration changes: the row before a delete, the row after anything else."""
    deleted = F.col("op") == "d"
    return envelopes.where(F.col("op").isNotNull()).select(
        "op",
        F.when(deleted, F.col("before")).alias("before"),
        F.when(~deleted, F.col("after")).alias("after"),
        F.try_element_at(F.col("before"), F.lit("sink_table")).alias("before_table"),
        F.when(~deleted, F.try_element_at(F.col("after"), F.lit("sink_table"))).alias("after_table"),
        "ts_ms",
    )


def route_by_config(envelopes: DataFrame, config: DataFrame) -> DataFrame:
    """Dimension rows for the tables the configuration names.

    ``config`` has one row per source table (``source_table``, ``sink_table``, ``sink_row_key``). The result has
    the target table, the hashed row key and all columns as text.
    """
    rows = envelopes.where(F.col("op").isNotNull() & (F.col("op") != "d")).withColumn("__t", F.col("source.table"))
    routed = attach(rows, config, {"__t": "source_table"},
                    {"sink_table": "sink_table", "__key": "sink_row_key"}, how="inner")
    return routed.select(
        "sink_table", F.md5(F.try_element_at(F.col("after"), F.col("__key"))).alias("row_key"),
        F.col("after").alias("columns"), "ts_ms")


def config_versions(changes: DataFrame) -> DataFrame:
    """Which configuration held when, from all its changes (see :func:`clean_config_cdc`).

    One row per source table and span: ``source_table``, ``sink_table``, ``sink_row_key``, ``valid_from`` (null: always, for
    a row that the initial snapshot read) and ``valid_to`` (exclusive; null: still). An update that moves a configuration to
    another source table ends it for the old one. Changes count in order of their time, at one time a delete first. A
    source table has few changes, so the window over them is small.
    """
    def of(side: str, name: str) -> Column:
        return F.try_element_at(F.col(side), F.lit(name))

    def step(side: str, live: bool) -> Column:
        return F.struct(of(side, "source_table").alias("source_table"), of(side, "sink_table").alias("sink_table"),
                        of(side, "sink_row_key").alias("sink_row_key"), F.lit(live).alias("live"))

    moved = (F.col("op") == "u") & ~of("before", "source_table").eqNullSafe(of("after", "source_table"))
    steps = F.array_compact(F.array(F.when((F.col("op") == "d") | moved, step("before", False)),
                                    F.when(F.col("op") != "d", step("after", True))))
    at = F.when(F.col("op") != "r", F.col("ts_ms"))
    rows = changes.select(at.alias("valid_from"), F.explode(steps).alias("s")).select("valid_from", "s.*").where("source_table is not null").distinct()
    ahead = Window.partitionBy("source_table").orderBy(F.col("valid_from").asc_nulls_first(), "live", "sink_table", "sink_row_key")
    spans = rows.withColumn("valid_to", F.lead("valid_from").over(ahead)).withColumn("__last", F.lead("live").over(ahead).isNull())
    return spans.where(F.col("live") & (F.col("__last") | F.col("valid_to").isNotNull())).select(
        "source_table", "sink_table", "sink_row_key", "valid_from", "valid_to")


def route_by_versions(envelopes: DataFrame, versions: DataFrame) -> DataFrame:
    """Dimension rows by the configuration that held at their time; a row without a time takes the one that holds now.

    ``versions`` comes from :func:`config_versions`. The source table is an equal key and the span a condition beside it.
    """
    rows = envelopes.where(F.col("op").isNotNull() & (F.col("op") != "d"))
    now, at = F.col("valid_to").isNull(), F.col("ts_ms")
    held = (F.col("valid_from").isNull() | (at >= F.col("valid_from"))) & (now | (at < F.col("valid_to")))
    routed = rows.join(versions, (F.col("source.table") == F.col("source_table")) & F.when(at.isNull(), now).otherwise(held))
    return routed.select(
        "sink_table", F.md5(F.try_element_at(F.col("after"), F.col("sink_row_key"))).alias("row_key"),
        F.col("after").alias("columns"), "ts_ms")


def comment_fact(envelopes: DataFrame) -> DataFrame:
    """Comment rows with the columns of the comment fact."""
    rows = envelopes.where((F.col("source.table") == "comment_info") & F.col("after").isNotNull())

    def text(name: str) -> Column:
        return F.try_element_at(F.col("after"), F.lit(name))

    return rows.select(
        "ts_ms", F.col("source.db").alias("db"), F.col("source.table").alias("table"),
        F.col("source.server_id").alias("server_id"), text("appraise").alias("appraise"),
        text("comment_txt").alias("commentTxt"), "op", text("nick_name").alias("nick_name"),
        *[text(c).try_cast("bigint").alias(c)
          for c in ("create_time", "user_id", "sku_id", "id", "spu_id", "order_id")])


def order_fact(envelopes: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Order rows: the row after the change if there is one, else the row before."""
    rows = envelopes.where(F.col("source.table") == "order_info")
    after = F.when(F.size("after") > 0, F.col("after"))
    rows = rows.withColumn("__row", F.coalesce(after, F.col("before")))
    return typed_payload(rows, schema, "__row", keep=["op", F.col("ts_ms").alias("tm_ms")])


def lookup_dim(stream: DataFrame, dim: DataFrame, key: str, dim_key: str, name: str, out: str,
               default: str = "N/A") -> DataFrame:
    """Name of a code from a dimension snapshot, ``default`` if it is unknown."""
    named = attach(stream, dim, {key: dim_key}, {out: name})
    return named.withColumn(out, F.coalesce(out, F.lit(default)))


def user_dim_rows(after: DataFrame, prefix: str = "dim_user_info") -> tuple[DataFrame, DataFrame]:
    """Inserted and updated users as (rows with salted key, rows without any key).

    The key is ``user_id``, else the key the extraction found; columns that start with two underscores are
    technical and dropped.
    """
    rows = after.where(F.lower("__op").isin("c", "u"))
    user = F.try_element_at(F.col("after"), F.lit("user_id"))
    rows = rows.withColumn("user_id", F.when(~is_blank(user), user).otherwise(F.col("__pk")))
    missing = is_blank(F.col("user_id"))
    columns = F.map_filter("after", lambda k, v: ~F.startswith(k, F.lit("__")) & v.isNotNull())
    good = rows.where(~missing).select(
        salted_key(prefix, F.col("user_id")).alias("row_key"), "user_id", columns.alias("columns"), "ts_ms")
    return good, rows.where(missing)


def with_phase(envelopes: DataFrame) -> DataFrame:
    """``snapshot`` or ``stream`` for each row, by operation or snapshot mark."""
    initial = (F.col("op") == "r") | (F.coalesce(F.col("source.snapshot"), F.lit("false")) == "true")
    return envelopes.withColumn("phase", F.when(initial, "snapshot").otherwise("stream"))


def comment_orders(joined: DataFrame) -> DataFrame:
    return add_day(joined, "ts_ms")
