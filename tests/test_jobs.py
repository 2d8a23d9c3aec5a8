"""Jobs in a layered store, and every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry_module  # noqa: E402
from check import TABLES, compare, rows_of  # noqa: E402
from fixtures.job_queries import BEHAVIOUR  # noqa: E402
from fixtures.logistics import logistics  # noqa: E402
from fixtures.plain import plain  # noqa: E402
from fixtures.retail import retail  # noqa: E402
from fixtures.runner_queries import stored_days  # noqa: E402
from fixtures.tables import EVENT_DAY, ORDER_DAY, Tables  # noqa: E402
from tidewater.plans import JOBS, Warehouse, materialize  # noqa: E402
from tidewater.session import work_dir  # noqa: E402

SF = "/root/testdata/sf0.001"
#: The training-data queries have no SQL; tests/llm holds them against brute force.
QUERIES = {n: q for n, q in entry_module.queries().items() if n not in entry_module.LLM_QUERIES}
SQL = {n: s for n, s in entry_module.oracle_sql().items() if n in QUERIES}
SLOW = ("stream_",)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for table in TABLES:
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return c


def test_every_query_has_sql_and_every_job_a_query():
    assert set(QUERIES) == set(SQL)
    assert {f"{d}_{n}" for d, n in JOBS} <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(SLOW)])
def test_query_matches_sql(spark, con, name):
    text, _, fine = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert fine or text.startswith("ok 0"), text


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["dt", "recent_days", "tm_id", "tm_name", "order_count", "order_user_count"]


@pytest.mark.parametrize("build, names, day", [
    (retail, ["ads_order_stats_by_tm", "ads_order_by_province", "ads_repeat_purchase_by_tm"], ORDER_DAY),
    (retail, ["ads_traffic_stats_by_channel", "ads_sku_favor_count_top3_by_tm"], EVENT_DAY),
    (logistics, ["ads_express_city_stats", "ads_shift_stats"], "2001-06-15"),
])
def test_stored_layers_give_the_same_reports(spark, build, names, day):
    tables = Tables(spark, SF)
    composed, root = build(tables), work_dir(spark, "layers")
    stored = materialize(spark, build(tables), root, names, day, days=30)
    assert all(stored.stored(n) for n in names)
    for name in names:
        want = plain(composed.run(name, day))
        got = plain(stored.run(name, day)).select(*want.columns)
        assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect()), name


def test_dated_snapshot_needs_a_day(spark):
    dim = spark.sql("SELECT 1 id, DATE'2024-01-01' dt UNION ALL SELECT 1, DATE'2024-01-02'")
    wh = Warehouse("retail", {"dim_province_full": dim})
    assert wh.snapshot("dim_province_full", "2024-01-02").count() == 1
    assert Warehouse("retail", {"dim_province_full": dim}, "2024-01-01").snapshot("dim_province_full").count() == 1
    with pytest.raises(ValueError):
        wh.snapshot("dim_province_full")


def test_daily_runs_rewrite_days_with_late_milestones(spark):
    stored = stored_days(retail, Tables(spark, SF), ["dwd_trade_trade_flow_acc"], ORDER_DAY).table("dwd_trade_trade_flow_acc")
    assert stored.count() == stored.select("order_id").distinct().count()
    late = stored.where((F.col("payment_date_id") == F.lit(ORDER_DAY).cast("date")) & (F.col("dt") < F.col("payment_date_id")))
    known = retail(Tables(spark, SF)).run("dwd_trade_trade_flow_acc").where(
        (F.col("payment_date_id") == F.lit(ORDER_DAY).cast("date")) & (F.col("dt") < F.col("payment_date_id")))
    assert late.count() == known.count()


def test_build_order_puts_inputs_first(spark):
    order = retail(Tables(spark, SF)).build_order(["ads_order_stats_by_tm"])
    assert order.index("dwd_trade_order_detail_inc") < order.index("dws_trade_user_sku_order_1d")
    assert order[-1] == "ads_order_stats_by_tm" and BEHAVIOUR


def test_scan_of_a_stored_day_prunes_partitions(spark):
    root = work_dir(spark, "prune")
    stored = materialize(spark, logistics(Tables(spark, SF)), root, ["dws_trans_dispatch_1d"], "2001-06-15")
    plan = stored.scan("dws_trans_dispatch_1d", "2001-06-15")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_date_filter_reaches_the_scan(spark):
    plan = retail(Tables(spark, SF)).run("ads_order_stats_by_tm", ORDER_DAY)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,2001-06-02T00:00)" in plan
