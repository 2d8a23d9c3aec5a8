"""Traffic source tables from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures.tables import EVENT_DAY, Tables, big, tag
from tidewater.plans import Warehouse


def traffic_tables(t: Tables) -> dict:
    events = t.event_rows()
    k, user = F.col("k"), F.col("user_id")

    def page_visit():
        return events.where("event_type <> 'error'").select(
            F.col("event_id").alias("visit_id"), "user_id", F.concat_ws("-", "user_id", "dt").alias("session_id"),
            tag("/p/", k % 40).alias("page_url"), tag("t", k % 4).alias("page_type"),
            F.when(user % 2 == 0, "wireless").otherwise("pc").alias("device"), F.col("ts").alias("event_time"),
            F.when(F.col("event_type") == "view", 1).otherwise(0).alias("is_entry"),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("is_order"), "dt")

    def log():
        shop = F.when(k % 3 == 0, tag("shop", k % 5))
        section = F.when(k % 3 == 1, tag("sec", k % 10))
        spu = F.when(k % 3 == 2, tag("spu", k % 20))
        return events.select(
            F.col("event_id").alias("log_id"), "user_id", shop.alias("shop_id"), section.alias("section_id"),
            spu.alias("spu_id"),
            F.element_at(F.array(F.lit("shop"), F.lit("section"), F.lit("item")), (k % 3 + 1).cast("int")).alias(
                "page_type"),
            big(F.floor("value")).alias("during_time"), F.col("ts").alias("request_time"), "dt")

    def numbers(n: int):
        return t.nation.where(F.col("n_nationkey") < n).select(F.col("n_nationkey").alias("i"))

    return {
        "ods_page_visit": page_visit,
        "ods_logs_inc": log,
        "ods_shop_full": lambda: numbers(5).select(tag("shop", "i").alias("shop_id"), tag("Shop ", "i").alias("shop_name")),
        "ods_section_full": lambda: numbers(10).select(
            tag("sec", "i").alias("section_id"), tag("Section ", "i").alias("section_name"),
            tag("shop", F.col("i") % 5).alias("shop_id")),
        "ods_spu_info_full": lambda: numbers(20).select(
            tag("spu", "i").alias("spu_id"), tag("Spu ", "i").alias("spu_name"),
            tag("sec", F.col("i") % 10).alias("section_id")),
        "dim_user_zip@open": lambda: t.customer.select(
            F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("level"),
            F.lit("2023-12-31").cast("date").alias("start_date"), F.lit("9999-12-31").cast("date").alias("end_date")),
        "ods_user_change": lambda: events.where("event_type = 'signup'").select(
            "user_id", tag("level ", k).alias("level"), F.col("ts").alias("update_time"),
            F.col("dt").alias("effective_date")),
    }


def traffic(t: Tables) -> Warehouse:
    return Warehouse("traffic", traffic_tables(t))


def traffic_by_day(t: Tables) -> Warehouse:
    """The same with a copy of every page table for each day of the log's last week."""
    tables = traffic_tables(t)
    days = F.explode(F.sequence(F.lit(EVENT_DAY).cast("date") - 6, F.lit(EVENT_DAY).cast("date")))

    def dated(name: str):
        return lambda: tables[name]().withColumn("dt", days)

    return Warehouse("traffic", {**tables, **{n: dated(n) for n in ("ods_shop_full", "ods_section_full", "ods_spu_info_full")}})
