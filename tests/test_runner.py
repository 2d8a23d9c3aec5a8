"""Daily runs: what a job reads, waybills over several days, histories kept by the day that closed a row."""

import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from fixtures.logistics import logistics_by_day  # noqa: E402
from fixtures.runner_queries import known_by, landed  # noqa: E402
from fixtures.tables import ORDER_DAY, Tables  # noqa: E402
from tidewater.plans import Warehouse, materialize, path_tables  # noqa: E402
from tidewater.plans.logistics import HEADER  # noqa: E402
from tidewater.plans.warehouse import DAY, SPECS, Window, daily_plan, job  # noqa: E402
from tidewater.session import work_dir  # noqa: E402

SF = "/root/testdata/sf0.001"
FACTS = ["dwd_trans_receive_detail_inc", "dwd_trans_sign_detail_inc", "dwd_trade_order_cancel_detail_inc"]
#: (waybill, day of July, state): one through all states with repeats, one signed at once and touched later, one cancelled
#: and touched, one that only now moves on, one that is revived after its cancellation.
LOG = [(1, 1, "60010"), (1, 1, "60020"), (1, 2, "60030"), (1, 2, "60040"), (1, 3, "60050"), (1, 3, "60070"), (1, 4, "60080"),
       (1, 5, "60080"), (2, 2, "60080"), (2, 3, "60080"), (2, 5, "60080"), (3, 1, "60030"), (3, 2, "60999"), (3, 3, "60999"),
       (4, 1, "60010"), (4, 5, "60080"), (5, 2, "60999"), (5, 4, "60030")]
PLACED = {1: 1, 2: 2, 3: 1, 4: 1, 5: 2}


@pytest.fixture(scope="module")
def waybills(spark):
    day = lambda n: f"2025-07-{n:02d}"
    words = {c: "x" for c in [*HEADER, "payment_type"]}
    rows = [{**words, "id": w, "status": s, "estimate_arrive_time": "0", "amount": "1.5", "create_time": f"{day(PLACED[w])}T00:00:00Z",
             "update_time": f"{day(d)}T{10 + i % 10}:00:00Z", "is_deleted": "0", "dt": day(d)} for i, (w, d, s) in enumerate(LOG)]
    change = spark.createDataFrame(rows).withColumn("dt", F.to_date("dt"))
    cargo = spark.createDataFrame(
        [(10 * w + i, w, "1", 1, 1, 1, 1.0, f"{day(d)}T00:00:00Z", "0", day(d)) for w, d in PLACED.items() for i in range(2)],
        "id long, order_id long, cargo_type string, volume_length long, volume_width long, volume_height long, weight double, "
        "create_time string, is_deleted string, dt string").withColumn("dt", F.to_date("dt"))
    dic = spark.createDataFrame([(1, "word", "0")], "id long, name string, is_deleted string")
    return Warehouse("logistics", {"ods_order_change": change, "ods_order_cargo": cargo, "ods_base_dic": dic})


def test_a_waybill_counts_once_per_event(spark, waybills):
    root = work_dir(spark, "events")
    for day, days in ((1, 30), (2, 1), (3, 1), (4, 1), (4, 1), (5, 1)):
        dt = f"2025-07-{day:02d}"
        materialize(spark, known_by(waybills, dt), root, FACTS, dt, days)
    stored = path_tables(spark, root, FACTS)
    whole = {n: {(r.id, str(r.dt)) for r in waybills.run(n).collect()} for n in FACTS}
    for name in FACTS:
        got = [(r.id, str(r.dt)) for r in stored[name]().collect()]
        assert len(got) == len(set(got)) and set(got) == whole[name], name
    days = {n: sorted({(i // 10, int(d[-2:])) for i, d in rows}) for n, rows in whole.items()}
    assert days == {FACTS[0]: [(1, 2), (2, 2), (3, 1), (4, 5)], FACTS[1]: [(1, 4), (2, 2), (4, 5)], FACTS[2]: [(3, 2), (5, 2)]}
    state = path_tables(spark, root, ["dwm_waybill_reached"])["dwm_waybill_reached"]()
    assert state.count() == 5 and state.where("dt = DATE'9999-12-31'").count() == 0


def test_every_dated_input_is_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    root, sources = work_dir(spark, "pruned"), work_dir(spark, "sources")
    wh = known_by(logistics_by_day(Tables(spark, SF)), ORDER_DAY)
    dated = ["ods_order_change", "ods_order_cargo", "ods_order_org_bound", "ods_order_info"]
    for name in dated:
        wh.table(name).where(F.col("dt") >= F.lit("2001-06-01").cast("date")).coalesce(1).write.partitionBy("dt").parquet(f"{sources}/{name}")
    stored = wh.derive(path_tables(spark, sources, dated))
    materialize(spark, stored, root, ["dwd_trans_sign_detail_inc"], "2001-06-30", 5)
    for name in ["dwm_waybill_reached", "dwd_trans_sign_detail_inc", "dwd_bound_sort_inc", "dwd_trade_order_detail_inc"]:
        plan = daily_plan(spark, stored, root, name, ORDER_DAY)._jdf.queryExecution().executedPlan().toString()
        reads = [n for n in SPECS["logistics", name].reads if n in dated]
        for source in reads:
            scan = [x for x in plan.split("\n") if "FileScan" in x and f"/{source}]" in x]
            assert scan and all("PartitionFilters: [" in x and "dt#" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scan), (name, source)
        assert reads


def test_windows(spark):
    @job("probe", "a", "b", "c", reads={"a": DAY, "b": Window(2), "c": Window(None)})
    def dwd_probe(wh, dt):
        return wh.table("a").unionAll(wh.table("b")).unionAll(wh.table("c"))

    days = spark.sql("SELECT explode(sequence(DATE'2025-01-01', DATE'2025-01-20')) dt")
    wh = Warehouse("probe", {n: days for n in "abc"}).window("dwd_probe", "2025-01-10", "2025-01-11")
    assert [wh.table(n).count() for n in "abc"] == [2, 4, 11]
    first = Warehouse("probe", {n: days for n in "abc"}).window("dwd_probe", None, "2025-01-11")
    assert [first.table(n).count() for n in "abc"] == [11, 11, 11]


def test_a_history_writes_only_open_rows_and_the_days_of_the_run(spark, tmp_path):
    changes = [(1, "a", "2025-07-01", 1), (2, "a", "2025-07-01", 2), (1, "b", "2025-07-02", 3), (1, "c", "2025-07-03", 4), (3, "z", "2025-07-03", 5)]
    log = spark.createDataFrame(changes, "user_id long, level string, day string, update_time long").withColumn("effective_date", F.to_date("day"))
    given = spark.sql("SELECT 1L user_id, '0' level, DATE'2025-01-01' start_date, DATE'9999-12-31' end_date")
    wh = Warehouse("traffic", {"dim_user_zip@open": given, "ods_user_change": log.drop("day")})
    root = str(tmp_path)

    def run(day, days=1):
        materialize(spark, known_by(wh, day), root, ["dim_user_zip"], day, days)
        rows = spark.read.parquet(f"{root}/dim_user_zip").select("user_id", "level", F.col("start_date").cast("string"), F.col("end_date").cast("string"))
        return sorted(map(tuple, rows.collect()))

    files = lambda dt: sorted(os.listdir(f"{root}/dim_user_zip/dt={dt}"))
    run("2025-07-01", 30)
    second = run("2025-07-02")
    closed = files("2025-07-02")
    third = run("2025-07-03")
    end = "9999-12-31"
    assert third == [(1, "0", "2025-01-01", "2025-06-30"), (1, "a", "2025-07-01", "2025-07-01"), (1, "b", "2025-07-02", "2025-07-02"),
                     (1, "c", "2025-07-03", end), (2, "a", "2025-07-01", end), (3, "z", "2025-07-03", end)]
    assert files("2025-07-02") == closed
    assert run("2025-07-03") == third
    assert run("2025-07-02") == second and run("2025-07-03") == third


def test_dated_full_tables_need_a_day(spark):
    copies = spark.sql("SELECT 'shop1' shop_id, 'Shop' shop_name, explode(array(DATE'2024-01-01', DATE'2024-01-02')) dt")
    with pytest.raises(ValueError, match="copy per day"):
        Warehouse("traffic", {"ods_shop_full": copies}).scan("ods_shop_full")


def test_growing_sources_are_computed_once(spark, tmp_path):
    calls, day = [], F.lit("2025-07-01").cast("date")

    def change():
        calls.append(1)
        return spark.range(5).withColumn("dt", day)

    wh = landed(Warehouse("logistics", {"ods_order_change": change, "ods_order_info": lambda: spark.range(3)}), str(tmp_path))
    for dt in ("2025-07-01", "2025-07-02"):
        table = known_by(wh, dt).table("ods_order_change")
        assert table.count() == 5 and all(str(tmp_path) in f for f in table.inputFiles())
    assert len(calls) == 1 and wh.table("ods_order_info").count() == 3


def test_first_report_reads_the_stored_to_date_tables(spark, tmp_path):
    sums = spark.createDataFrame([(5, 7.5)], "order_count long, order_amount double")
    for name in ("dws_trans_dispatch_td", "dws_trans_bound_finish_td"):
        sums.write.parquet(f"{tmp_path}/{name}/dt=2025-07-01")
    wh = Warehouse("logistics", {n: (lambda: pytest.fail("history read again")) for n in ("ods_order_change", "ods_order_cargo", "ods_base_dic")})
    got = daily_plan(spark, wh, str(tmp_path), "ads_trans_order_stats_td", "2025-07-01").collect()
    assert [(r.bounding_order_count, r.bounding_order_amount) for r in got] == [(0, 0.0)]


def test_a_waybill_keeps_one_rank_for_all_columns(spark, waybills):
    fact = waybills.run("dwd_trans_receive_detail_inc")
    line = next(x for x in fact._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [id" in x)
    assert line.count("min_by(") <= 4 and "unix_timestamp" not in line
    small = fact.groupBy("order_id").agg(F.max("amount"))._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in small.split("\n") if "Aggregate [id" in x)
    assert line.count("min_by(") == 1 and "struct(" not in line
