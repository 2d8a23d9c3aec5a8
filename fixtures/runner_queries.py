"""Queries that run the warehouse day after day, one day twice, and read what is stored."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.logistics import logistics_by_day
from fixtures.plain import plain
from fixtures.retail import retail
from fixtures.tables import EVENT_DAY, ORDER_DAY, Tables
from fixtures.traffic import traffic_by_day
from tidewater.plans import Warehouse, materialize
from tidewater.session import work_dir


def known_by(wh: Warehouse, dt: str) -> Warehouse:
    """The source tables without the rows of days after ``dt``. Order headers stay: the given tables date some of them
    after their lines."""

    def cut(name: str) -> DataFrame:
        df = wh.table(name)
        day = next((c for c in ("dt", "effective_date") if c in df.columns), None)
        return df if name == "ods_order_info" or day is None else df.where(F.col(day) <= F.lit(dt).cast("date"))

    return wh.derive({n: (lambda n=n: cut(n)) for n in list(wh._tables)})


def days_before(dt: str, n: int) -> str:
    return str(date.fromisoformat(dt) - timedelta(days=n))


#: Sources that every job of a run reads again and that the fixtures compute from other tables.
GROWING = ("ods_order_change", "ods_order_cargo")


def landed(wh: Warehouse, root: str) -> Warehouse:
    """The warehouse with its growing sources stored as files, as a deployment finds them, so that runs and jobs read them
    instead of computing every row again."""

    def land(name: str) -> DataFrame:
        df, path = wh.table(name), f"{root}/{name}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return wh.derive({n: (lambda n=n: land(n)) for n in GROWING if wh.stored(n)})


def stored_days(build: Callable[[Tables], Warehouse], t: Tables, names: list[str], dt: str, n: int = 2) -> Warehouse:
    """A run on each of ``n`` days up to ``dt``, the first with the 30 days before it, and ``dt`` once more."""
    root = work_dir(t.spark, "runner")
    wh = landed(build(t), work_dir(t.spark, "sources"))
    for i in range(n):
        day = days_before(dt, n - 1 - i)
        materialize(t.spark, known_by(wh, day), root, names, day, 30 if i == 0 else 1)
    return materialize(t.spark, known_by(wh, dt), root, names, dt)


#: Registered name: where from, the job whose stored table is read, the last day, and how many days of it are read (a report
#: or a to-date table has one, a fact the days of all runs, a history all).
RUNNERS: dict[str, tuple[Callable[[Tables], Warehouse], str, str, int | None]] = {
    "runner_retail_order_stats": (retail, "ads_order_stats_by_tm", ORDER_DAY, 1),
    "runner_retail_order_to_date": (retail, "dws_trade_user_order_td", ORDER_DAY, 1),
    "runner_retail_order_to_pay": (retail, "ads_order_to_pay_interval_avg", ORDER_DAY, 1),
    "runner_retail_user_history": (retail, "dim_user_zip", ORDER_DAY, None),
    "runner_retail_login_to_date": (retail, "dws_user_user_login_td", EVENT_DAY, 1),
    "runner_logistics_waybill_reached": (logistics_by_day, "dwm_waybill_reached", ORDER_DAY, None),
    "runner_logistics_sign": (logistics_by_day, "dwd_trans_sign_detail_inc", ORDER_DAY, 32),
    "runner_logistics_under_way": (logistics_by_day, "ads_trans_order_stats_td", ORDER_DAY, 1),
    "runner_logistics_trans_order": (logistics_by_day, "ads_trans_order_stats", ORDER_DAY, 1),
    "runner_traffic_section_visit": (traffic_by_day, "ads_section_visit", EVENT_DAY, 1),
    "runner_traffic_user_history": (traffic_by_day, "dim_user_zip", EVENT_DAY, None),
}


def _runner(build: Callable[[Tables], Warehouse], name: str, dt: str, days: int | None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = stored_days(build, Tables(spark, sf_dir), [name], dt, 2 if name.startswith("ads_") else 3).table(name)
        if days is not None:
            rows = rows.where(F.col("dt").between(F.lit(days_before(dt, days - 1)).cast("date"), F.lit(dt).cast("date")))
        return plain(rows if name.startswith(("ads_", "dwd_")) else rows.drop("dt"))

    return query


def runner_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q: _runner(*spec) for q, spec in RUNNERS.items()}
