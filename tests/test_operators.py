"""Hand cases of the operators."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidewater.functions import cond_sum
from tidewater.operators import cdc, logs
from tidewater.operators.dims import scd2_init, scd2_merge
from tidewater.operators.joins import attach, decode, resolve_level
from tidewater.operators.reports import churned, driver_split, page_path, repeat_rate, returned, share_of
from tidewater.operators.rollups import (
    dedup_sum,
    distinct_count,
    first_last_avg,
    incremental_to_date,
    n_day_columns,
    n_day_entities,
    n_day_rows,
    total,
    unpivot_days,
)
from tidewater.operators.sequences import consecutive_days, latest, rank_all, sequence_rows, top_k, top_share
from tidewater.operators.sets import collect_values, combine_scalars, metric_merge, signed_balance, union_distinct

D = dt.date


def days(df, *columns):
    return df.withColumns({c: F.col(c).cast("date") for c in columns or ["dt"]})


def test_amount_repeated_on_lines_counts_once(spark, rows):
    df = spark.createDataFrame([(1, "a", 10), (1, "a", 10), (1, "a", 10), (2, "a", 5)], "o int, k string, amt int")
    assert rows(dedup_sum(df, "o", ["k"], "amt", "n", "s")) == [("a", 2, 15)]


def test_level_decides_city_and_province(spark, rows):
    region = spark.createDataFrame([(1, None, "P"), (10, 1, "C"), (100, 10, "D")], "id int, parent_id int, name string")
    organ = spark.createDataFrame([(7, 1, 10), (8, 2, 100), (9, 2, 999)], "id int, org_level int, region_id int")
    df = spark.createDataFrame([(7,), (8,), (9,)], "org_id int")
    out = resolve_level(df, organ, region)
    assert rows(out, "org_id", "city_name", "province_name") == [(7, "C", "P"), (8, "C", "P"), (9, None, None)]


def test_two_drivers_share_distance_but_not_counts(spark, rows):
    df = spark.createDataFrame(
        [(7, 1, "A", None, None, 100.0, 1), (7, 1, "A", 2, "B", 100.0, 1), (7, 1, "A", 2, "B", 100.0, 1)],
        "recent_days int, driver1_emp_id int, driver1_name string, driver2_emp_id int, driver2_name string, km double, n int")
    split = driver_split(df, ["km"], ["n"], ["recent_days"])
    out = split.groupBy("driver_emp_id").agg(F.sum("km"), F.sum("n"))
    assert rows(out) == [(1, 200.0, 3), (2, 100.0, 2)]


def test_merge_keeps_keys_of_every_set(spark, rows):
    a = spark.createDataFrame([("x", 1)], "k string, a int")
    b = spark.createDataFrame([("y", 2), (None, 5)], "k string, b int")
    c = spark.createDataFrame([("y", 3), ("z", 4), (None, 6)], "k string, c int")
    assert rows(metric_merge([a, b, c], ["k"], ["a", "b", "c"])) == sorted(
        [("x", 1, None, None), ("y", None, 2, 3), ("z", None, None, 4), (None, None, 5, 6)], key=repr)


def test_consecutive_days(spark, rows):
    df = days(spark.createDataFrame(
        [(1, "2024-01-01"), (1, "2024-01-02"), (1, "2024-01-03"), (1, "2024-01-03"), (2, "2024-01-01"),
         (3, "2024-01-01"), (3, "2024-01-02"), (3, "2024-01-04")], "u int, dt string"))
    assert rows(consecutive_days(df, "u", "dt", 3)) == [(1,)]


def test_paths_of_short_and_long_sessions(spark, rows):
    df = spark.createDataFrame(
        [("s1", 1, "home"), ("s2", 1, "home"), ("s2", 70, "cart"), ("s2", 200, "pay")], "s string, t int, p string")
    out = page_path(df, ["s"], ["t"], "p", F.floor(F.col("t") / 60))
    assert rows(out) == sorted([
        ("step-1:home", "null", 1), ("step-1:home", "step-2:cart", 1), ("step-2:cart", "step-3:pay", 1),
        ("step-3:pay", "null", 1)], key=repr)


def test_sequences_equal_plain_windows_for_any_bucket_width(spark):
    from pyspark.sql.window import Window

    df = spark.range(2000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("k"), (F.col("id") * 37 % 1999).alias("t"), "id",
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {r["id"]: (r["n"], r["i"]) for r in df.select("id", F.lead("v").over(w).alias("n"),
                                                         F.row_number().over(w).alias("i")).collect()}
    for width in (1, 50, 5000):
        got = sequence_rows(df, ["k"], ["t", "id"], F.floor(F.col("t") / width), next_of={"n": "v"}, index="i")
        assert {r["id"]: (r["n"], r["i"]) for r in got.collect()} == want


def test_churn_and_return(spark, rows):
    today = days(spark.createDataFrame(
        [(1, "2024-01-23"), (2, "2024-01-22"), (3, "2024-01-30"), (4, "2024-01-30")],
        "user_id int, login_date_last string"), "login_date_last")
    previous = days(spark.createDataFrame([(3, "2024-01-22"), (4, "2024-01-23")],
                                          "user_id int, login_date_last string"), "login_date_last")
    assert rows(combine_scalars([churned(today, "2024-01-30"), returned(today, previous, "2024-01-30")])) == [(1, 1)]


def test_top_three_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([9, 8, 7, 7, 6])], "g string, i int, v int")
    assert rows(top_k(df, ["g"], [F.col("v").desc()], 3), "i", "rk") == [(0, 1), (1, 2), (2, 3), (3, 3)]
    assert rows(rank_all(df, "v"), "i", "rk") == [(0, 1), (1, 2), (2, 3), (3, 3), (4, 5)]


def test_rank_over_many_values(spark):
    rng = random.Random(3)
    values = [None if i % 50 == 0 else rng.choice([0, -1, 1, -2.5, 2.0**40, rng.uniform(-9, 9), rng.randint(-2000, 2000)]) for i in range(400)]
    got = rank_all(spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double"), "v")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    known = [v for v in values if v is not None]
    want = sorted(1 + (sum(x > v for x in known) if v is not None else len(known)) for v in values)
    assert sorted(r.rk for r in got.collect()) == want
    windows = [line.split("windowspecdefinition(")[1] for line in plan.split("\n") if "windowspecdefinition(" in line]
    assert windows and all(w.startswith("__c#") for w in windows)


def test_shares_read_the_aggregate_once(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 0), (None, "x", 5)], "g string, p string, n int")
    got = share_of(df, ["g"], {"ratio": "n"})
    assert rows(got) == sorted([("a", "x", 0.25), ("a", "y", 0.75), ("b", "x", None)], key=repr)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_top_share_counts_all_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1), ("c", 9)], "p string, u int")
    assert rows(top_share(df, "p", "u", 1)) == [("a", 2, 0.5)]


def test_scd2_merge(spark, rows):
    base = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-05")],
                                 "id int, v string, d string")
    open_rows = scd2_init(base.drop("d").join(base.select("id", "d"), "id"), F.col("d").cast("date")).drop("d")
    changes = days(spark.createDataFrame(
        [(1, "a2", "2024-01-05", 1), (1, "a3", "2024-01-05", 2), (1, "a4", "2024-01-07", 3), (3, "c2", "2024-01-05", 4),
         (4, "new", "2024-01-06", 5)], "id int, v string, day string, seq int"), "day")
    out = scd2_merge(open_rows, changes, "id", "day", ["seq"])
    end = D(9999, 12, 31)
    assert rows(out) == sorted([
        (1, "a", D(2024, 1, 1), D(2024, 1, 4)), (1, "a3", D(2024, 1, 5), D(2024, 1, 6)), (1, "a4", D(2024, 1, 7), end),
        (2, "b", D(2024, 1, 1), end), (3, "c2", D(2024, 1, 5), end), (4, "new", D(2024, 1, 6), end)], key=repr)
    again = scd2_merge(out.where(F.col("end_date") == F.lit("9999-12-31").cast("date")), changes.where("seq = 5"), "id",
                       "day", ["seq"])
    assert again.where("id = 4").count() == 1


def test_windows_nest_and_agree(spark, rows):
    df = days(spark.createDataFrame(
        [("a", 1, "2024-01-30", 5), ("a", 1, "2024-01-24", 1), ("a", 2, "2024-01-23", 2), ("a", 3, "2024-01-01", 4),
         ("b", 3, "2023-12-31", 9), ("c", 4, "2024-01-31", 9)], "k string, u int, dt string, v int"))
    base = "2024-01-30"
    flat = rows(n_day_rows(df, base, [1, 7, 30], ["k"], {"v": "v"}))
    assert flat == [("a", 1, 5), ("a", 30, 12), ("a", 7, 6)]
    people = rows(n_day_entities(df, base, [1, 7, 30], ["k"], "u", "users", {"v": F.col("v")}))
    assert people == [("a", 1, 1, 5), ("a", 30, 3, 12), ("a", 7, 1, 6)]
    wide = n_day_columns(df, base, [7, 30], ["k"], {"v": "v"})
    assert rows(wide) == [("a", 6, 12)]
    assert rows(unpivot_days(wide, [7, 30], ["v"], ["k"])) == [("a", 30, 12), ("a", 7, 6)]


def test_empty_input(spark, rows):
    empty = spark.createDataFrame([], "k string, v int, dt date")
    assert rows(total(empty, {"v": "v"})) == [(None,)]
    assert rows(n_day_rows(empty, "2024-01-30", [7], [], {"v": "v"})) == []
    assert rows(empty.agg(cond_sum(F.col("v"), F.lit(True)))) == [(None,)]


def test_small_aggregates(spark, rows):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 20), ("a", 2, 5), ("b", 9, 1)], "k string, o int, v int")
    assert rows(distinct_count(df, ["k"], "o", "n", {"v": F.sum("v")}, F.col("v") > 5)) == [("a", 1, 35), ("b", 0, 1)]
    assert rows(first_last_avg(df, ["k"], "v"))[0] == ("a", 5, 20, 35 / 3)
    assert rows(latest(df, ["k"], ["v"])) == [("a", 1, 20), ("b", 9, 1)]
    assert rows(collect_values(df, "k", "o", "os")) == [("a", [1, 2]), ("b", [9])]
    assert rows(union_distinct([df, df])) == rows(df)
    assert rows(signed_balance(df, df.where("v < 20"), ["k"], {"s": "v"})) == [("a", 20), ("b", 0)]
    assert rows(repeat_rate(df.withColumn("n", F.lit(1)), "o", ["k"], "n", "r"))[0][1] == 0.5
    assert rows(share_of(df, ["k"], {"s": "v"}), "k", "o", "s")[-1] == ("b", 9, 1.0)


def test_login_totals(spark, rows):
    schema = "u int, f string, l string, n int"
    old = spark.createDataFrame([(1, "a", "b", 2), (2, "a", "a", 1)], schema)
    new = spark.createDataFrame([(1, "c", "c", 1), (3, "c", "c", 4)], schema)
    assert rows(incremental_to_date(old, new, "u", "f", "l", "n")) == [(1, "a", "c", 3), (2, "a", "a", 1), (3, "c", "c", 4)]


def test_dictionary_lookup_stays_in_its_group(spark, rows):
    dic = spark.createDataFrame([("1", "pay", "11"), ("1", "act", "31")], "id string, dic_name string, parent_code string")
    df = spark.createDataFrame([("1",), ("2",)], "code string")
    assert rows(decode(df, "code", dic, "31", "name")) == [("1", "act"), ("2", None)]
    assert rows(attach(df, dic, {"code": "id"}, {"code": "dic_name"}, how="inner")) == [("act",), ("pay",)]


# ---- changes and logs

CHANGES = [
    '{"op":"r","after":{"id":1,"sink_table":"t"},"source":{"db":"d","table":"order_info"},"ts_ms":1704067200000}',
    '{"op":"c","after":{"id":2},"source":{"table":"cart_info"},"ts_ms":2}',
    '{"op":"u","before":{"id":3},"after":{"id":33},"source":{"table":"cart_info"},"ts_ms":3}',
    '{"op":"d","before":{"id":4,"sink_table":"old"},"source":{"table":"order_detail"},"ts_ms":4}',
    '{"payload":{"op":"c","after":{"order_id":5},"source":{"table":"ods_order_info"},"ts_ms":5}}',
    '{"op":"c","after":{"id":6},"ts_ms":6}',
    "not json", "",
]


def changes(spark):
    return cdc.parse_envelope(spark.createDataFrame([(c,) for c in CHANGES], "value string"))


def test_normalised_changes(spark, rows):
    out = cdc.typed_payload(cdc.normalize_cdc(changes(spark)), "id int", keep=["_table", "op"])
    assert rows(out) == sorted([(1, "order_info", "c"), (2, "cart_info", "c"), (33, "cart_info", "u"),
                                (4, "order_detail", "d"), (None, "ods_order_info", "c"), (6, None, "c")], key=repr)
    routed = cdc.route_by_table(cdc.normalize_cdc(changes(spark)))
    assert {k: v.count() for k, v in routed.items() if v.count()} == {"order_info": 1, "cart_add": 1, "order_detail": 1}


def test_extracted_rows_and_topics(spark, rows):
    after = cdc.extract_after(changes(spark))
    assert rows(after.where("`__pk` is not null"), "__op", "__table", "__pk") == [("c", "ods_order_info", "5")]
    assert after.count() == 5
    topics = rows(after.select(cdc.dwd_topic(F.col("__table")).alias("t")).distinct())
    assert topics == [("dwd_behavior_log",), ("dwd_order_info",), ("dwd_unknown",)]
    raw = {r[0] for r in changes(spark).select(cdc.ods_topic(F.col("source.table"), raw=True)).collect()}
    assert "ods_mysql_unknown_raw" in raw and "ods_mysql_cart_info_raw" in raw


def test_config_and_phase(spark, rows):
    out = cdc.clean_config_cdc(changes(spark)).where("before_table is not null or after_table is not null")
    assert rows(out, "op", "before_table", "after_table") == [("d", "old", None), ("r", None, "t")]
    assert cdc.with_phase(changes(spark)).where("phase = 'snapshot'").count() == 1


def test_user_rows_without_key(spark):
    df = spark.createDataFrame([({"user_id": "7", "__x": "1", "n": None}, "C", None, 1), ({"user_id": " "}, "u", "8", 2),
                                ({"a": "1"}, "c", None, 3), ({"user_id": "9"}, "r", None, 4)],
                               "after map<string,string>, __op string, __pk string, ts_ms bigint")
    good, missing = cdc.user_dim_rows(df)
    assert {r["user_id"]: r["columns"] for r in good.collect()} == {"7": {"user_id": "7"}, "8": {"user_id": " "}}
    assert missing.count() == 1


LOGS = [
    '{"common":{"mid":"m1","uid":"null"},"actions":[{"action_id":"CLICK","item":"5","item_type":"SKU_ID"},'
    '{"action_id":"cart_add","sku_id":"6","ts":9}],"ts":1}',
    '{"common":{"mid":"m1","uid":"u1"},"action":{"action_id":"favor_add","item":"7","item_type":"sku_id"},"ts":2}',
    '{"uid":"u9","action_id":"good_click","sku_id":"8","ts":3}',
    '{"common":{"mid":"m2"},"action":{"action_id":"scroll","item":"7","item_type":"sku_id"},"ts":4}',
    '{"common":{"mid":"m2"},"action":{"action_id":"click","item":"p","item_type":"page"},"ts":5}',
]


def test_actions_in_every_form(spark, rows):
    good, dirty = logs.split_dirty(spark.createDataFrame([(x,) for x in [*LOGS, "{oops", "[1"]], "value string"))
    assert dirty.count() == 2
    assert rows(logs.normalize_action(good), "ts", "visitor", "sku_id", "metric") == [
        (1, "m1", "5", "click"), (2, "u1", "7", "favor"), (3, "u9", "8", "click"), (9, "m1", "6", "cart")]


def test_displays(spark, rows):
    texts = ['{"common":{"mid":"m"},"display":{"item":"1","item_type":"sku_id"},"ts":1}',
             '{"common":{"mid":"m"},"sku_id":"2","ts":2}',
             '{"common":{"mid":"m"},"display":{"item":"3","item_type":"banner"},"ts":3}',
             '{"common":{"mid":"m"},"item":"4","item_type":"SKU_ID","ts":4}']
    good, _ = logs.split_dirty(spark.createDataFrame([(x,) for x in texts], "value string"))
    assert rows(logs.normalize_display(good), "ts", "sku_id") == [(1, "1"), (2, "2"), (4, "4")]


def test_first_visit_flag(spark, rows):
    day = 86400000
    df = spark.createDataFrame([("a", 5 * day), ("a", 5 * day + 1), ("a", 6 * day), ("b", 6 * day)], "mid string, ts bigint")
    assert rows(logs.fix_is_new(df)) == [("a", 5 * day, "1"), ("a", 5 * day + 1, "1"), ("a", 6 * day, "0"), ("b", 6 * day, "1")]


def test_listed_last_word(spark, rows):
    df = spark.createDataFrame([(1, "fine,bad"), (2, "bad,fine"), (3, ",,"), (4, None)], "i int, t string")
    words = spark.createDataFrame([("bad",), ("bad",), ("",)], "word string")
    assert rows(logs.flag_sensitive(df, "t", words), "i", "is_violation", "violation_msg") == [
        (1, 1, "bad"), (2, 0, ""), (3, 0, ""), (4, 0, "")]
