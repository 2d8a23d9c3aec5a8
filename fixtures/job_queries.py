"""One query per warehouse job, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fixtures.logistics import logistics
from fixtures.plain import plain
from fixtures.retail import retail, retail_from_events
from fixtures.tables import EVENT_DAY, ORDER_DAY, Tables
from fixtures.traffic import traffic
from tidewater.plans import JOBS, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# Retail reports on behaviour run on the day of the events, those on trade on the order day.
BEHAVIOUR = {
    "ads_traffic_stats_by_channel", "ads_page_path", "ads_user_change", "ads_user_stats", "ads_user_action",
    "ads_sku_cart_num_top3_by_cate", "ads_sku_favor_count_top3_by_tm", "dws_user_user_login_td",
}


def _job(build: Callable[[Tables], Warehouse], name: str, dt: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Tables(spark, sf_dir)).run(name, dt))

    query.__name__ = name
    return query


def _day(domain: str, name: str) -> str | None:
    """Dimensions, facts and one-day tables run over all days, n-day tables and reports on one."""
    if name.startswith("ads_") or name.endswith(("_nd", "_td")):
        return EVENT_DAY if domain == "traffic" or name in BEHAVIOUR else ORDER_DAY
    return "1995-01-01" if name == "dim_user_zip_init" else None


def job_queries() -> dict[str, Query]:
    builds = {"retail": retail, "logistics": logistics, "traffic": traffic}
    out = {}
    for domain, name in JOBS:
        build = retail_from_events if name == "ads_user_action" else builds[domain]
        out[f"{domain}_{name}"] = _job(build, name, _day(domain, name))
    out["retail_dws_trade_user_sku_order_1d_daily"] = _job(retail, "dws_trade_user_sku_order_1d", ORDER_DAY)
    return out

