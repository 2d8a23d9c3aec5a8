"""Page-traffic dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dims import scd2_merge, scd2_reopen
from tidewater.operators.joins import attach
from tidewater.operators.reports import share_of
from tidewater.operators.rollups import in_days, n_day_columns
from tidewater.operators.sequences import next_value, rank_all, top_share
from tidewater.plans.warehouse import DAY, Intervals, Warehouse, Window, job

DAYS = [1, 7, 30]


def _report(df: DataFrame, dt: str) -> DataFrame:
    return df.select(F.lit(dt).cast("date").alias("dt"), *[c for c in df.columns if c != "dt"])


def _minute():
    return F.date_trunc("minute", F.col("event_time"))


@job("traffic", "ods_page_visit")
def ads_wireless_entry(wh: Warehouse, dt: str) -> DataFrame:
    """Entry pages on phones: visitors and those among them who ordered, for 1, 7 and 30 days.

    Per page and user only the last entry day and the last entry day with an order are kept; both answer every
    window.
    """
    visits = wh.table("ods_page_visit").where((F.col("device") == "wireless") & in_days(F.col("dt"), dt, max(DAYS)))
    buyers = visits.where(F.col("is_order") == 1).groupBy("dt", "user_id").agg(F.lit(1).alias("__bought"))
    entries = visits.where(F.col("is_entry") == 1).select("dt", "page_url", "user_id").distinct()
    marked = entries.join(buyers, ["dt", "user_id"], "left")
    per_user = marked.groupBy("page_url", "user_id").agg(
        F.max("dt").alias("__seen"), F.max(F.when(F.col("__bought") == 1, F.col("dt"))).alias("__buy"))
    counts = per_user.groupBy("page_url").agg(*[
        c for n in DAYS for c in (
            F.count(F.when(in_days(F.col("__seen"), dt, n), 1)).alias(f"visitor_count_{n}d"),
            F.count(F.when(in_days(F.col("__buy"), dt, n), 1)).alias(f"buyer_count_{n}d"))])
    return _report(counts, dt)


@job("traffic", "ods_page_visit")
def ads_page_visit_rank(wh: Warehouse, dt: str) -> DataFrame:
    """Visitors and mean stay per page; the stay lasts until the session's next page."""
    visits = wh.scan("ods_page_visit", dt)
    ahead = next_value(visits, ["session_id"], ["event_time", "visit_id"], "event_time", "__next", _minute())
    stay = F.unix_timestamp("__next") - F.unix_timestamp("event_time")
    per_user = ahead.groupBy("page_url", "user_id").agg(F.sum(stay).alias("__stay"), F.count(stay).alias("__n"))
    pages = per_user.groupBy("page_url").agg(
        F.count("user_id").alias("visitor_count"),
        F.floor(F.try_divide(F.sum("__stay"), F.sum("__n"))).cast("bigint").alias("avg_stay_sec"))
    return _report(rank_all(pages, "visitor_count"), dt)


@job("traffic", "ods_page_visit")
def ads_in_store_path(wh: Warehouse, dt: str) -> DataFrame:
    """Visits that went from one page to the next, not de-duplicated."""
    visits = wh.scan("ods_page_visit", dt)
    ahead = next_value(visits, ["session_id"], ["event_time", "visit_id"], "page_url", "target_page", _minute())
    moves = ahead.where(F.col("target_page").isNotNull())
    return _report(moves.groupBy(F.col("page_url").alias("source_page"), "target_page").agg(
        F.count(F.lit(1)).alias("visitor_count")), dt)


@job("traffic", "ods_page_visit")
def ads_pc_source(wh: Warehouse, dt: str) -> DataFrame:
    """Top 20 source pages of desktop visitors with their share."""
    pc = wh.scan("ods_page_visit", dt).where(F.col("device") == "pc")
    return _report(top_share(pc, "page_url", "user_id", 20), dt)


@job("traffic", "ods_logs_inc", "ods_shop_full", "ods_section_full", "ods_spu_info_full", reads={"ods_logs_inc": DAY})
def dwd_logs_wide(wh: Warehouse, dt: str | None) -> DataFrame:
    """Log rows with names; an item page inherits its section and a section page its shop."""
    log = wh.scan("ods_logs_inc", dt)
    log = attach(log, wh.snapshot("ods_spu_info_full", dt), {"spu_id": "spu_id"},
                 {"spu_name": "spu_name", "__section": "section_id"})
    log = log.withColumn("section_id", F.coalesce("__section", "section_id")).drop("__section")
    log = attach(log, wh.snapshot("ods_section_full", dt), {"section_id": "section_id"},
                 {"section_name": "section_name", "__shop": "shop_id"})
    log = log.withColumn("shop_id", F.coalesce("__shop", "shop_id")).drop("__shop")
    return attach(log, wh.snapshot("ods_shop_full", dt), {"shop_id": "shop_id"}, {"shop_name": "shop_name"})


def _visits(wh: Warehouse, dt: str, keys: list[str]) -> DataFrame:
    log = wh.table("dwd_logs_wide").where(F.col(keys[-2]).isNotNull())
    return n_day_columns(log.withColumn("__one", F.lit(1)), dt, DAYS, keys, {"visit_count": "__one"})


@job("traffic", "dwd_logs_wide")
def ads_spu_visit(wh: Warehouse, dt: str) -> DataFrame:
    return _report(_visits(wh, dt, ["spu_id", "spu_name"]), dt)


@job("traffic", "dwd_logs_wide")
def ads_section_visit(wh: Warehouse, dt: str) -> DataFrame:
    return _report(_visits(wh, dt, ["section_id", "section_name"]), dt)


@job("traffic", "dwd_logs_wide")
def ads_shop_visit(wh: Warehouse, dt: str) -> DataFrame:
    return _report(_visits(wh, dt, ["shop_id", "shop_name"]), dt)


def _ratios(wh: Warehouse, dt: str, group: list[str], part: list[str]) -> DataFrame:
    visits = _visits(wh, dt, [*group, *part])
    return _report(share_of(visits, group, {f"ratio_{n}d": f"visit_count_{n}d" for n in DAYS}), dt)


@job("traffic", "dwd_logs_wide")
def ads_section_spu_ratio(wh: Warehouse, dt: str) -> DataFrame:
    return _ratios(wh, dt, ["section_id", "section_name"], ["spu_id", "spu_name"])


@job("traffic", "dwd_logs_wide")
def ads_shop_section_ratio(wh: Warehouse, dt: str) -> DataFrame:
    return _ratios(wh, dt, ["shop_id", "shop_name"], ["section_id", "section_name"])


@job("traffic", "dwd_logs_wide")
def ads_shop_avg_stay(wh: Warehouse, dt: str) -> DataFrame:
    log = wh.table("dwd_logs_wide").where(F.col("shop_id").isNotNull())
    sums = n_day_columns(log.withColumn("__one", F.lit(1)), dt, DAYS, ["shop_id", "shop_name"],
                         {"__n": "__one", "__t": "during_time"})
    return _report(sums.select("shop_id", "shop_name", *[
        F.try_divide(F.col(f"__t_{n}d").cast("double"), F.col(f"__n_{n}d")).alias(f"avg_stay_time_{n}d")
        for n in DAYS]), dt)


@job("traffic", "dim_user_zip@open", "ods_user_change", reads={"ods_user_change": Window(day="effective_date")},
     intervals=Intervals(scd2_reopen, "start_date"))
def dim_user_zip(wh: Warehouse, dt: str | None) -> DataFrame:
    """User history of the traffic warehouse; the first run starts from the given open versions."""
    before = wh.before("dim_user_zip")
    open_rows = wh.table("dim_user_zip@open") if before is None else before
    return scd2_merge(open_rows, wh.scan("ods_user_change", dt), "user_id", "effective_date", ["update_time"])
