"""Logistics warehouse: dimensions, waybill and transport facts, roll-ups and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import (
    anon,
    duration_sec,
    iso_trim,
    mask_name,
    ms_to_date,
    ms_to_time,
    ratio,
)
from tidewater.functions.masking import EMAIL, PHONE
from tidewater.operators.dims import OPEN_END, scd2_init
from tidewater.operators.facts import close_interval, first_reach, merge_reach, reach_before, transaction_fact
from tidewater.operators.joins import alive, attach, flatten_star, parent_chain, resolve_level
from tidewater.operators.reports import driver_split
from tidewater.operators.rollups import dedup_sum, n_day_rows, one_day, total
from tidewater.operators.sets import collect_values, metric_merge, signed_balance, union_all
from tidewater.plans.warehouse import DAY, OPEN_DAYS, Intervals, Warehouse, job

# Waybill states in the order a waybill passes them, and the state of a cancelled one.
REACHED = {"order": "60010", "pay": "60020", "receive": "60030", "dispatch": "60050", "bound_finish": "60060",
           "deliver": "60070", "sign": "60080"}
SIGNED, CANCELLED = "60080", "60999"
EVENTS, CLOSING = [*list(REACHED)[1:], "cancel"], ["sign", "cancel"]

HEADER = ["order_no", "status", "collect_type", "user_id", "receiver_complex_id", "receiver_province_id",
          "receiver_city_id", "receiver_district_id", "receiver_name", "sender_complex_id", "sender_province_id",
          "sender_city_id", "sender_district_id", "sender_name", "cargo_num", "amount", "estimate_arrive_time",
          "distance"]
# Columns of a waybill that its roll-ups read.
ROLLED = ["amount", "sender_district_id", "receiver_district_id"]
PLACE = ["city_id", "city_name", "province_id", "province_name"]


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _stamp(df: DataFrame, dt: str | None) -> DataFrame:
    return df if dt is None else df.withColumn("dt", F.lit(dt).cast("date"))


def _report(df: DataFrame, dt: str) -> DataFrame:
    return df.select(F.lit(dt).cast("date").alias("dt"), *[c for c in df.columns if c != "dt"])


def _live(wh: Warehouse, name: str, dt: str | None = None) -> DataFrame:
    return alive(wh.scan(name, dt))


# ---- dimensions


@job("logistics", "ods_base_complex", "ods_base_region_info", "ods_express_courier_complex")
def dim_complex_full(wh: Warehouse, dt: str | None) -> DataFrame:
    region = _live(wh, "ods_base_region_info", dt)
    estate = _live(wh, "ods_base_complex", dt).select(
        "id", "complex_name", "province_id", "city_id", "district_id", "district_name")
    estate = attach(estate, region, {"province_id": "id"}, {"province_name": "name"}, how="inner")
    estate = attach(estate, region, {"city_id": "id"}, {"city_name": "name"}, how="inner")
    couriers = collect_values(_live(wh, "ods_express_courier_complex", dt), "complex_id",
                              F.col("courier_emp_id").cast("string"), "courier_emp_ids")
    wide = attach(estate, couriers, {"id": "complex_id"}, _same("courier_emp_ids"))
    return _stamp(wide.select("id", "complex_name", "courier_emp_ids", "province_id", "province_name", "city_id",
                              "city_name", "district_id", "district_name"), dt)


@job("logistics", "ods_base_organ", "ods_base_region_info")
def dim_organ_full(wh: Warehouse, dt: str | None) -> DataFrame:
    organ = _live(wh, "ods_base_organ", dt).select("id", "org_name", "org_level", "region_id", "org_parent_id")
    wide = flatten_star(organ, [
        (_live(wh, "ods_base_region_info", dt), {"region_id": "id"},
         {"region_name": "name", "region_code": "dict_code"}),
        (organ, {"org_parent_id": "id"}, {"org_parent_name": "org_name"}),
    ])
    return _stamp(wide, dt)


@job("logistics", "ods_base_region_info")
def dim_region_full(wh: Warehouse, dt: str | None) -> DataFrame:
    return _stamp(_live(wh, "ods_base_region_info", dt).select(
        "id", "parent_id", "name", "dict_code", "short_name"), dt)


@job("logistics", "ods_express_courier", "ods_base_organ", "ods_base_dic")
def dim_express_courier_full(wh: Warehouse, dt: str | None) -> DataFrame:
    courier = _live(wh, "ods_express_courier", dt).select(
        "id", "emp_id", "org_id", anon(F.col("working_phone")).alias("working_phone"), "express_type")
    courier = attach(courier, _live(wh, "ods_base_organ", dt), {"org_id": "id"}, _same("org_name"), how="inner")
    courier = attach(courier, _live(wh, "ods_base_dic", dt), {"express_type": "id"},
                     {"express_type_name": "name"}, how="inner")
    return _stamp(courier, dt)


@job("logistics", "ods_line_base_shift", "ods_line_base_info", "ods_base_dic")
def dim_shift_full(wh: Warehouse, dt: str | None) -> DataFrame:
    shift = _live(wh, "ods_line_base_shift", dt).select(
        "id", "line_id", "start_time", "driver1_emp_id", "driver2_emp_id", "truck_id", "pair_shift_id")
    line = ["line_no", "line_level", "org_id", "transport_line_type_id", "start_org_id", "start_org_name",
            "end_org_id", "end_org_name", "pair_line_id", "distance", "cost", "estimated_time"]
    wide = attach(shift, _live(wh, "ods_line_base_info", dt), {"line_id": "id"},
                  {"line_name": "name", **_same(*line)}, how="inner")
    wide = attach(wide, _live(wh, "ods_base_dic", dt), {"transport_line_type_id": "id"},
                  {"transport_line_type_name": "name"}, how="inner")
    return _stamp(wide.select(
        "id", "line_id", "line_name", "line_no", "line_level", "org_id", "transport_line_type_id",
        "transport_line_type_name", "start_org_id", "start_org_name", "end_org_id", "end_org_name",
        "pair_line_id", "distance", "cost", "estimated_time", "start_time", "driver1_emp_id", "driver2_emp_id",
        "truck_id", "pair_shift_id"), dt)


@job("logistics", "ods_truck_driver", "ods_base_organ", "ods_truck_team")
def dim_truck_driver_full(wh: Warehouse, dt: str | None) -> DataFrame:
    driver = _live(wh, "ods_truck_driver", dt).select(
        "id", "emp_id", "org_id", "team_id", "license_type", "init_license_date", "expire_date", "license_no",
        "is_enabled")
    driver = attach(driver, _live(wh, "ods_base_organ", dt), {"org_id": "id"}, _same("org_name"), how="inner")
    driver = attach(driver, _live(wh, "ods_truck_team", dt), {"team_id": "id"}, {"team_name": "name"}, how="inner")
    return _stamp(driver, dt)


@job("logistics", "ods_truck_info", "ods_truck_team", "ods_truck_model", "ods_base_organ", "ods_base_dic")
def dim_truck_full(wh: Warehouse, dt: str | None) -> DataFrame:
    truck = _live(wh, "ods_truck_info", dt).select(
        "id", "team_id", anon(F.col("truck_no")).alias("truck_no"), "truck_model_id", "device_gps_id", "engine_no",
        "license_registration_date", "license_last_check_date", "license_expire_date", "is_enabled")
    size = ["truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd", "boxcar_hg",
            "max_speed", "oil_vol"]
    truck = attach(truck, _live(wh, "ods_truck_team", dt), {"team_id": "id"},
                   {"team_name": "name", **_same("team_no", "org_id", "manager_emp_id")}, how="inner")
    truck = attach(truck, _live(wh, "ods_truck_model", dt), {"truck_model_id": "id"},
                   {"truck_model_name": "model_name", "truck_model_type": "model_type",
                    "truck_model_no": "model_no", "truck_brand": "brand", **_same(*size)}, how="inner")
    truck = attach(truck, _live(wh, "ods_base_organ", dt), {"org_id": "id"}, _same("org_name"), how="inner")
    dic = _live(wh, "ods_base_dic", dt)
    truck = attach(truck, dic, {"truck_model_type": "id"}, {"truck_model_type_name": "name"}, how="inner")
    truck = attach(truck, dic, {"truck_brand": "id"}, {"truck_brand_name": "name"}, how="inner")
    return _stamp(truck, dt)


@job("logistics", "ods_user_info")
def dim_user_zip(wh: Warehouse, dt: str | None) -> DataFrame:
    """First load of the user history; personal data is hashed, invalid phones and addresses become null."""
    users = _live(wh, "ods_user_info", dt).select(
        "id", "login_name", "nick_name", anon(F.col("passwd")).alias("passwd"),
        anon(F.col("real_name")).alias("real_name"), anon(F.col("phone_num"), PHONE).alias("phone_num"),
        anon(F.col("email"), EMAIL).alias("email"), "user_level",
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("birthday").cast("int")).alias("birthday"), "gender",
        ms_to_date(F.col("create_time")).alias("__start"))
    return scd2_init(users, F.col("__start")).drop("__start")


@job("logistics", "ods_user_address")
def dim_user_address_zip(wh: Warehouse, dt: str | None) -> DataFrame:
    address = _live(wh, "ods_user_address", dt).select(
        "id", "user_id", anon(F.col("phone"), PHONE).alias("phone"), "province_id", "city_id", "district_id",
        "complex_id", "address", "is_default", iso_trim(F.col("create_time")).alias("__start"))
    return scd2_init(address, F.col("__start")).drop("__start")


# ---- waybill facts


def _cargo(wh: Warehouse, dt: str | None) -> DataFrame:
    return _live(wh, "ods_order_cargo", dt).select(
        "id", "order_id", "cargo_type", "volume_length", "volume_width", "volume_height", "weight",
        iso_trim(F.col("create_time")).alias("__created"))


def _waybills(wh: Warehouse, name: str = "ods_order_info") -> DataFrame:
    return _live(wh, name).withColumns({
        "receiver_name": mask_name(F.col("receiver_name")),
        "sender_name": mask_name(F.col("sender_name")),
        "estimate_arrive_time": ms_to_time(F.col("estimate_arrive_time")),
        "updated": iso_trim(F.col("update_time")),
        "placed": F.to_date(F.substring("create_time", 1, 10)),
    })


def _has_reached(event: str) -> Column:
    status = F.col("status")
    return status == CANCELLED if event == "cancel" else (status >= REACHED[event]) & (status != CANCELLED)


def _reach_before(rows: DataFrame, first: str) -> DataFrame:
    return _closing_day(reach_before(rows.drop("dt"), EVENTS, "placed", first))


def _closing_day(rows: DataFrame) -> DataFrame:
    end = F.least(*CLOSING)
    return rows.withColumn("dt", close_interval(end.isNotNull(), F.to_date(end)))


@job("logistics", "ods_order_change", reads={"ods_order_change": DAY}, intervals=Intervals(_reach_before, "placed"))
def dwm_waybill_reached(wh: Warehouse, dt: str | None) -> DataFrame:
    """When each waybill reached each event for the first time; open until it is signed or cancelled."""
    log = _waybills(wh, "ods_order_change").withColumn("at", F.to_timestamp("updated"))
    new = first_reach(log, "id", "at", {e: _has_reached(e) for e in EVENTS}, CLOSING, "placed")
    before = wh.before("dwm_waybill_reached")
    if before is not None:
        new = merge_reach(before, new, "id", "placed", EVENTS, CLOSING, wh.since)
    return _closing_day(new)


def _first_changes(wh: Warehouse, event: str, take: list[str]) -> DataFrame:
    """The change with which a waybill reached an event for the first time, its time as ``updated``; nothing counts after it
    was closed.

    Changes are ordered by one number made of time and state; changes of one waybill with the same time and state are taken
    as one change. The columns of the roll-ups are aggregates of their own and all others one together, so that a roll-up does
    not carry those and a fact does not keep twenty ranks a waybill. Time and rank are columns before the aggregate.
    """
    reached, closed = _has_reached(event), _has_reached("sign") | _has_reached("cancel")
    log = _waybills(wh, "ods_order_change").where(reached | closed).withColumn(
        "__second", F.unix_timestamp(F.to_timestamp("updated")))
    log = log.withColumns({"__rank": F.when(reached, F.col("__second") * 100_000 + F.col("status").cast("int")),
                           "__end": F.when(closed, F.col("__second"))})
    own, rest = [c for c in take if c in ROLLED], [c for c in take if c not in ROLLED and c != "updated"]
    best = log.groupBy("id").agg(
        F.min("__rank").alias("__first"), F.min("__end").alias("__closed"), F.min("placed").alias("__placed"),
        *[F.min_by(c, "__rank").alias(c) for c in own], F.min_by(F.struct(*rest), "__rank").alias("__rest"))
    best = best.select("id", "__first", "__closed", "__placed", *own, *[F.col(f"__rest.{c}").alias(c) for c in rest])
    at = F.floor(F.col("__first") / 100_000)
    first = best.withColumn("updated", F.timestamp_seconds(at)).where(
        F.col("__first").isNotNull() & F.coalesce(at <= F.col("__closed"), F.lit(True)))
    before = wh.before("dwm_waybill_reached")
    if before is not None:
        done = F.col(event).isNotNull() | (F.col("dt") != F.lit(OPEN_END).cast("date"))
        first = attach(first, before.select("id", done.alias("done")), {"id": "id"}, {"__done": "done"})
        first = first.where(F.coalesce(~F.col("__done"), F.col("__placed") >= F.lit(wh.since).cast("date")))
    return first.select("id", *take)


def _waybill_fact(wh: Warehouse, dt: str | None, event: str, name: str) -> DataFrame:
    """Cargo lines of the waybills that reached ``event``, dated by the event.

    The order event is dated by the cargo line, every later event by the change with which the waybill first reached it.
    """
    by_line = event == "order"
    day = None if dt is None else F.lit(dt).cast("date")
    codes = [("cargo_type", "cargo_type_name"), ("status", "status_name"), ("collect_type", "collect_type_name")]
    take = [*HEADER, "updated"]
    if not by_line:
        codes.append(("payment_type", "payment_type_name"))
        take.append("payment_type")
    lines = _cargo(wh, None)
    header = _waybills(wh) if by_line else _first_changes(wh, event, take)
    if day is not None and by_line:
        lines = lines.where(F.to_date("__created") == day)
    elif day is not None:
        header = header.where(F.to_date("updated") == day)
    dic = alive(wh.snapshot("ods_base_dic", dt)).select(F.col("id").cast("string").alias("id"), "name")
    fact = transaction_fact(lines, header, {"order_id": "id"}, take,
                            F.to_timestamp(F.col("__created" if by_line else "updated")), name, codes, dic)
    return fact.drop("__created", "updated")


#: A run reads its own days of the change log, and the cargo lines since the oldest open waybill was placed.
EVENT = {"reads": {"ods_order_change": DAY, "ods_order_cargo": OPEN_DAYS}, "state": "dwm_waybill_reached"}


@job("logistics", "ods_order_cargo", "ods_order_info", "ods_base_dic", reads={"ods_order_cargo": DAY, "ods_order_info": DAY})
def dwd_trade_order_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "order", "order_time")


@job("logistics", "ods_order_cargo", "ods_order_change", "ods_base_dic", **EVENT)
def dwd_trade_pay_suc_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "pay", "payment_time")


@job("logistics", "ods_order_cargo", "ods_order_change", "ods_base_dic", **EVENT)
def dwd_trade_order_cancel_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "cancel", "cancel_time")


@job("logistics", "ods_order_cargo", "ods_order_change", "ods_base_dic", **EVENT)
def dwd_trans_receive_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "receive", "receive_time")


@job("logistics", "ods_order_cargo", "ods_order_change", "ods_base_dic", **EVENT)
def dwd_trans_dispatch_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "dispatch", "dispatch_time")


@job("logistics", "ods_order_cargo", "ods_order_change", "ods_base_dic", **EVENT)
def dwd_trans_bound_finish_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "bound_finish", "bound_finish_time")


@job("logistics", "ods_order_cargo", "ods_order_change", "ods_base_dic", **EVENT)
def dwd_trans_deliver_suc_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "deliver", "deliver_suc_time")


@job("logistics", "ods_order_cargo", "ods_order_change", "ods_base_dic", **EVENT)
def dwd_trans_sign_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _waybill_fact(wh, dt, "sign", "sign_time")


@job("logistics", "ods_order_cargo", "ods_order_info", "ods_base_dic")
def dwd_trade_order_process_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    """Accumulating snapshot: open until the waybill is signed or cancelled; stored by end day."""
    codes = [("cargo_type", "cargo_type_name"), ("status", "status_name"), ("collect_type", "collect_type_name"),
             ("payment_type", "payment_type_name")]
    dic = alive(wh.snapshot("ods_base_dic", dt)).select(F.col("id").cast("string").alias("id"), "name")
    header = _waybills(wh).withColumn(
        "end_date", close_interval(F.col("status").isin(SIGNED, CANCELLED), F.substring("updated", 1, 10)))
    fact = transaction_fact(_cargo(wh, None), header, {"order_id": "id"}, [*HEADER, "payment_type", "end_date"],
                            F.to_timestamp("__created"), "order_time", codes, dic)
    fact = fact.withColumnRenamed("dt", "start_date").withColumn("dt", F.col("end_date")).drop("__created")
    return fact if dt is None else fact.where(F.col("dt") == F.lit(dt).cast("date"))


@job("logistics", "ods_transport_task", "dim_shift_full", reads={"ods_transport_task": DAY})
def dwd_trans_trans_finish_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    """Finished trips; the estimated end is the start plus the estimated minutes of the shift."""
    start, end = F.col("actual_start_time"), F.col("actual_end_time")
    trips = wh.scan("ods_transport_task", dt).select(
        "id", "shift_id", "line_id", "start_org_id", "start_org_name", "end_org_id", "end_org_name", "order_num",
        "driver1_emp_id", mask_name(F.col("driver1_name")).alias("driver1_name"), "driver2_emp_id",
        mask_name(F.col("driver2_name")).alias("driver2_name"), "truck_id", anon(F.col("truck_no")).alias("truck_no"),
        F.timestamp_millis(start.cast("bigint")).alias("actual_start_time"),
        F.timestamp_millis(end.cast("bigint")).alias("actual_end_time"), "actual_distance",
        duration_sec(start, end).alias("finish_dur_sec"), "dt")
    trips = attach(trips, wh.snapshot("dim_shift_full", dt), {"shift_id": "id"}, {"__minutes": "estimated_time"})
    estimate = F.timestamp_seconds(F.unix_timestamp("actual_start_time") + F.col("__minutes") * 60)
    return trips.withColumn("estimate_end_time", estimate).drop("__minutes")


def _bound(wh: Warehouse, dt: str | None, time: str, emp: str) -> DataFrame:
    moves = wh.table("ods_order_org_bound").where(F.col(time).isNotNull())
    fact = moves.select("id", "order_id", "org_id", ms_to_time(F.col(time)).alias(time), emp,
                        ms_to_date(F.col(time)).alias("dt"))
    return fact if dt is None else fact.where(F.col("dt") == F.lit(dt).cast("date"))


@job("logistics", "ods_order_org_bound", reads={"ods_order_org_bound": DAY})
def dwd_bound_inbound_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _bound(wh, dt, "inbound_time", "inbound_emp_id")


@job("logistics", "ods_order_org_bound", reads={"ods_order_org_bound": DAY})
def dwd_bound_sort_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _bound(wh, dt, "sort_time", "sorter_emp_id")


@job("logistics", "ods_order_org_bound", reads={"ods_order_org_bound": DAY})
def dwd_bound_outbound_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return _bound(wh, dt, "outbound_time", "outbound_emp_id")


# ---- one-day roll-ups


def _org_of_district(wh: Warehouse, df: DataFrame, district: str, dt: str | None) -> DataFrame:
    return attach(df, wh.snapshot("dim_organ_full", dt), {district: "region_id"},
                  {"org_id": "id", "org_name": "org_name", "__region": "region_id"})


def _org_place(wh: Warehouse, df: DataFrame, dt: str | None) -> DataFrame:
    """City and province above the organisation's district."""
    df = parent_chain(df, wh.snapshot("dim_region_full", dt), "__region", ["__district", "city", "province"])
    return df.drop("__region", "__district_id", "__district_name")


@job("logistics", "dwd_trade_order_detail_inc", "dim_organ_full", "dim_region_full", reads={"dwd_trade_order_detail_inc": DAY})
def dws_trade_org_cargo_type_order_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    daily = dedup_sum(wh.scan("dwd_trade_order_detail_inc", dt), "order_id",
                      ["cargo_type", "cargo_type_name", "sender_district_id", "sender_city_id", "dt"], "amount",
                      "order_count", "order_amount")
    placed = attach(daily, wh.snapshot("dim_organ_full", dt), {"sender_district_id": "region_id"},
                    {"org_id": "id", "org_name": "org_name"}).withColumnRenamed("sender_city_id", "city_id")
    keys = ["org_id", "org_name", "city_id", "cargo_type", "cargo_type_name", "dt"]
    merged = one_day(placed, keys, {"order_count": "order_count", "order_amount": "order_amount"})
    return attach(merged, wh.snapshot("dim_region_full", dt), {"city_id": "id"}, {"city_name": "name"})


@job("logistics", "dwd_trans_dispatch_detail_inc", reads={"dwd_trans_dispatch_detail_inc": DAY})
def dws_trans_dispatch_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return dedup_sum(wh.scan("dwd_trans_dispatch_detail_inc", dt), "order_id", ["dt"], "amount", "order_count",
                     "order_amount")


def _org_orders(wh: Warehouse, dt: str | None, fact: str, district: str, amount: bool) -> DataFrame:
    """Waybills per organisation: count and add up per district first, then name the places."""
    daily = dedup_sum(wh.scan(fact, dt), "order_id", [district, "dt"], "amount", "order_count",
                      "order_amount" if amount else None)
    placed = _org_place(wh, _org_of_district(wh, daily, district, dt), dt)
    sums = {"order_count": "order_count", **({"order_amount": "order_amount"} if amount else {})}
    return one_day(placed, ["org_id", "org_name", *PLACE, "dt"], sums)


@job("logistics", "dwd_trans_deliver_suc_detail_inc", "dim_organ_full", "dim_region_full", reads={"dwd_trans_deliver_suc_detail_inc": DAY})
def dws_trans_org_deliver_suc_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return _org_orders(wh, dt, "dwd_trans_deliver_suc_detail_inc", "receiver_district_id", amount=False)


@job("logistics", "dwd_trans_receive_detail_inc", "dim_organ_full", "dim_region_full", reads={"dwd_trans_receive_detail_inc": DAY})
def dws_trans_org_receive_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return _org_orders(wh, dt, "dwd_trans_receive_detail_inc", "sender_district_id", amount=True)


@job("logistics", "dwd_bound_sort_inc", "dim_organ_full", "dim_region_full", reads={"dwd_bound_sort_inc": DAY})
def dws_trans_org_sort_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    daily = one_day(wh.scan("dwd_bound_sort_inc", dt), ["org_id", "dt"], {"sort_count": F.count(F.lit(1))})
    organ = wh.snapshot("dim_organ_full", dt)
    named = attach(daily, organ, {"org_id": "id"}, _same("org_name"))
    return resolve_level(named, organ, wh.snapshot("dim_region_full", dt))


@job("logistics", "dwd_trans_trans_finish_inc", "dim_truck_full", reads={"dwd_trans_trans_finish_inc": DAY})
def dws_trans_org_truck_model_type_trans_finish_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    trips = wh.scan("dwd_trans_trans_finish_inc", dt).withColumnsRenamed(
        {"start_org_id": "org_id", "start_org_name": "org_name"})
    per_truck = one_day(trips, ["org_id", "org_name", "truck_id", "dt"], {
        "trans_finish_count": F.count("id"), "trans_finish_distance": "actual_distance",
        "trans_finish_dur_sec": "finish_dur_sec"})
    typed = attach(per_truck, wh.snapshot("dim_truck_full", dt), {"truck_id": "id"},
                   _same("truck_model_type", "truck_model_type_name"))
    return one_day(typed, ["org_id", "org_name", "truck_model_type", "truck_model_type_name", "dt"],
                   _same("trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"))


# ---- n-day and to-date roll-ups

DAYS = [7, 30]


@job("logistics", "dws_trade_org_cargo_type_order_1d")
def dws_trade_org_cargo_type_order_nd(wh: Warehouse, dt: str) -> DataFrame:
    return n_day_rows(wh.table("dws_trade_org_cargo_type_order_1d"), dt, DAYS,
                      ["org_id", "org_name", "city_id", "city_name", "cargo_type", "cargo_type_name"],
                      _same("order_count", "order_amount"))


def _added(old: DataFrame, new: DataFrame) -> DataFrame:
    """Totals to date plus new ones, in the types that are stored already."""
    sums = total(union_all([old, new]), _same("order_count", "order_amount"))
    return sums.select(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in sums.columns])


@job("logistics", "dwd_trans_bound_finish_detail_inc")
def dws_trans_bound_finish_td(wh: Warehouse, dt: str) -> DataFrame:
    """Waybills finished to date: the table of the day before plus the day, or the whole history. A waybill finishes once."""
    old = wh.before("dws_trans_bound_finish_td")
    rows = wh.table("dwd_trans_bound_finish_detail_inc")
    days = F.col("dt") <= F.lit(dt).cast("date") if old is None else F.col("dt") == F.lit(dt).cast("date")
    new = dedup_sum(rows.where(days), "order_id", [], "amount", "order_count", "order_amount")
    return new if old is None else _added(old, new)


@job("logistics", "dws_trans_dispatch_1d")
def dws_trans_dispatch_nd(wh: Warehouse, dt: str) -> DataFrame:
    return n_day_rows(wh.table("dws_trans_dispatch_1d"), dt, DAYS, [], _same("order_count", "order_amount"))


@job("logistics", "dws_trans_dispatch_1d")
def dws_trans_dispatch_td(wh: Warehouse, dt: str) -> DataFrame:
    old, day = wh.before("dws_trans_dispatch_td"), F.lit(dt).cast("date")
    rows = wh.table("dws_trans_dispatch_1d").where(F.col("dt") <= day if old is None else F.col("dt") == day)
    return total(rows, _same("order_count", "order_amount")) if old is None else _added(old, rows.drop("dt"))


@job("logistics", "dws_trans_org_deliver_suc_1d")
def dws_trans_org_deliver_suc_nd(wh: Warehouse, dt: str) -> DataFrame:
    return n_day_rows(wh.table("dws_trans_org_deliver_suc_1d"), dt, DAYS, ["org_id", "org_name", *PLACE],
                      _same("order_count"))


@job("logistics", "dws_trans_org_receive_1d")
def dws_trans_org_receive_nd(wh: Warehouse, dt: str) -> DataFrame:
    return n_day_rows(wh.table("dws_trans_org_receive_1d"), dt, DAYS, ["org_id", "org_name", *PLACE],
                      _same("order_count", "order_amount"))


@job("logistics", "dws_trans_org_sort_1d")
def dws_trans_org_sort_nd(wh: Warehouse, dt: str) -> DataFrame:
    return n_day_rows(wh.table("dws_trans_org_sort_1d"), dt, DAYS, ["org_id", "org_name", *PLACE],
                      _same("sort_count"))


@job("logistics", "dwd_trans_trans_finish_inc", "dim_organ_full", "dim_region_full", "dim_shift_full",
     "dim_truck_full")
def dws_trans_shift_trans_finish_nd(wh: Warehouse, dt: str) -> DataFrame:
    trips = wh.table("dwd_trans_trans_finish_inc").withColumnsRenamed(
        {"start_org_id": "org_id", "start_org_name": "org_name"})
    late = F.when(F.col("actual_end_time") > F.col("estimate_end_time"), 1).otherwise(0)
    keys = ["shift_id", "line_id", "org_id", "org_name", "driver1_emp_id", "driver1_name", "driver2_emp_id",
            "driver2_name", "truck_id"]
    rows = n_day_rows(trips, dt, DAYS, keys, {
        "trans_finish_count": F.lit(1).cast("bigint"), "trans_finish_distance": "actual_distance",
        "trans_finish_dur_sec": "finish_dur_sec", "trans_finish_order_count": "order_num",
        "trans_finish_delay_count": late.cast("bigint")})
    rows = resolve_level(rows, wh.snapshot("dim_organ_full", dt), wh.snapshot("dim_region_full", dt))
    rows = attach(rows, wh.snapshot("dim_shift_full", dt), {"shift_id": "id"}, _same("line_name"))
    rows = attach(rows, wh.snapshot("dim_truck_full", dt), {"truck_id": "id"},
                  _same("truck_model_type", "truck_model_type_name"))
    return rows.select(
        "shift_id", "city_id", "city_name", "org_id", "org_name", "line_id", "line_name", "driver1_emp_id",
        "driver1_name", "driver2_emp_id", "driver2_name", "truck_model_type", "truck_model_type_name",
        "recent_days", "trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec",
        "trans_finish_order_count", "trans_finish_delay_count")


# ---- reports

TRIP = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]


def _trip_means(df: DataFrame) -> DataFrame:
    n = F.col("trans_finish_count")
    return df.withColumns({
        "avg_trans_finish_distance": ratio(F.col("trans_finish_distance"), n),
        "avg_trans_finish_dur_sec": F.floor(F.try_divide(F.col("trans_finish_dur_sec"), n)).cast("bigint"),
    })


def _one_and_n(one: DataFrame, nd: DataFrame) -> DataFrame:
    """The day's rows as the one-day window next to the n-day rows."""
    return union_all([one.withColumn("recent_days", F.lit(1)), nd])


def _summed(wh: Warehouse, dt: str, one: str, nd: str, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Sums per key for 1, 7 and 30 days. A stored n-day table is read next to the day's rows; otherwise all three
    windows come from one pass over the daily table."""
    if not wh.stored(nd):
        return n_day_rows(wh.table(one), dt, [1, *DAYS], keys, sums)
    both = _one_and_n(wh.at(one, dt).drop("dt"), wh.at(nd, dt))
    return one_day(both, ["recent_days", *keys], sums)


def _trips_1d_by_org(wh: Warehouse, dt: str) -> DataFrame:
    return one_day(wh.at("dws_trans_org_truck_model_type_trans_finish_1d", dt), ["org_id", "org_name"],
                   _same(*TRIP))


def _trips_by_org(wh: Warehouse, dt: str) -> DataFrame:
    """Trips per organisation for 1, 7 and 30 days, in one pass over the finished trips."""
    trips = wh.table("dwd_trans_trans_finish_inc").withColumnsRenamed({"start_org_id": "org_id", "start_org_name": "org_name"})
    return n_day_rows(trips, dt, [1, *DAYS], ["org_id", "org_name"], {
        "trans_finish_count": F.lit(1).cast("bigint"), "trans_finish_distance": "actual_distance", "trans_finish_dur_sec": "finish_dur_sec"})


def _orders_and_trips(wh: Warehouse, dt: str, keys: list[str]) -> DataFrame:
    """Orders next to trips for each key and window; a key may be in only one of the two. Stored trip tables are read; where
    they are not stored, all windows come from one pass over the trips."""
    orders = _summed(wh, dt, "dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd", keys,
                     _same("order_count", "order_amount"))
    placed = "city_id" in keys
    place = (lambda df: resolve_level(df, wh.snapshot("dim_organ_full", dt), wh.snapshot("dim_region_full", dt))) if placed else (lambda df: df)
    if wh.stored("dws_trans_shift_trans_finish_nd"):
        trips_nd = wh.at("dws_trans_shift_trans_finish_nd", dt).select("recent_days", *keys, *TRIP)
        trips = _one_and_n(place(_trips_1d_by_org(wh, dt)).select(*keys, *TRIP), trips_nd)
    else:
        trips = place(_trips_by_org(wh, dt))
    trips = one_day(trips, ["recent_days", *keys], _same(*TRIP))
    merged = metric_merge([orders, trips], ["recent_days", *keys], ["order_count", "order_amount", *TRIP])
    return _report(_trip_means(merged), dt)


@job("logistics", "dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd",
     "dws_trans_org_truck_model_type_trans_finish_1d", "dws_trans_shift_trans_finish_nd", "dim_organ_full",
     "dim_region_full")
def ads_city_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _orders_and_trips(wh, dt, ["city_id", "city_name"])


@job("logistics", "dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd",
     "dws_trans_org_truck_model_type_trans_finish_1d", "dws_trans_shift_trans_finish_nd")
def ads_org_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _orders_and_trips(wh, dt, ["org_id", "org_name"])


@job("logistics", "dws_trans_shift_trans_finish_nd")
def ads_driver_stats(wh: Warehouse, dt: str) -> DataFrame:
    trips = wh.at("dws_trans_shift_trans_finish_nd", dt)
    split = driver_split(trips, ["trans_finish_distance", "trans_finish_dur_sec"],
                         ["trans_finish_count", "trans_finish_delay_count"], ["recent_days"])
    per_driver = one_day(split, ["recent_days", "driver_emp_id", "driver_name"],
                         {**_same(*TRIP), "trans_finish_late_count": "trans_finish_delay_count"})
    return _report(_trip_means(per_driver), dt)


def _express(wh: Warehouse, dt: str, keys: list[str]) -> DataFrame:
    """Received, delivered and sorted counts per key for 1, 7 and 30 days."""
    received = _summed(wh, dt, "dws_trans_org_receive_1d", "dws_trans_org_receive_nd", keys,
                       {"receive_order_count": "order_count", "receive_order_amount": "order_amount"})
    delivered = _summed(wh, dt, "dws_trans_org_deliver_suc_1d", "dws_trans_org_deliver_suc_nd", keys,
                        {"deliver_suc_count": "order_count"})
    sorts = _summed(wh, dt, "dws_trans_org_sort_1d", "dws_trans_org_sort_nd", keys, _same("sort_count"))
    return _report(metric_merge(
        [received, delivered, sorts], ["recent_days", *keys],
        ["receive_order_count", "receive_order_amount", "deliver_suc_count", "sort_count"]), dt)


EXPRESS_INPUTS = ("dws_trans_org_receive_1d", "dws_trans_org_receive_nd", "dws_trans_org_deliver_suc_1d",
                  "dws_trans_org_deliver_suc_nd", "dws_trans_org_sort_1d", "dws_trans_org_sort_nd")


@job("logistics", *EXPRESS_INPUTS)
def ads_express_city_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _express(wh, dt, ["city_id", "city_name"])


@job("logistics", *EXPRESS_INPUTS)
def ads_express_org_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _express(wh, dt, ["org_id", "org_name"])


@job("logistics", *EXPRESS_INPUTS)
def ads_express_province_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _express(wh, dt, ["province_id", "province_name"])


@job("logistics", "dws_trans_org_deliver_suc_1d", "dws_trans_org_deliver_suc_nd", "dws_trans_org_sort_1d",
     "dws_trans_org_sort_nd")
def ads_express_stats(wh: Warehouse, dt: str) -> DataFrame:
    delivered = _summed(wh, dt, "dws_trans_org_deliver_suc_1d", "dws_trans_org_deliver_suc_nd", [],
                        {"deliver_suc_count": "order_count"})
    sorts = _summed(wh, dt, "dws_trans_org_sort_1d", "dws_trans_org_sort_nd", [], _same("sort_count"))
    return _report(metric_merge([delivered, sorts], ["recent_days"], ["deliver_suc_count", "sort_count"]), dt)


@job("logistics", "dws_trans_shift_trans_finish_nd")
def ads_line_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _report(one_day(wh.at("dws_trans_shift_trans_finish_nd", dt), ["recent_days", "line_id", "line_name"],
                           _same(*TRIP, "trans_finish_order_count")), dt)


@job("logistics", "dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd")
def ads_order_cargo_type_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _report(_summed(wh, dt, "dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd",
                           ["cargo_type", "cargo_type_name"], _same("order_count", "order_amount")), dt)


@job("logistics", "dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd")
def ads_order_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _report(_summed(wh, dt, "dws_trade_org_cargo_type_order_1d", "dws_trade_org_cargo_type_order_nd", [],
                           _same("order_count", "order_amount")), dt)


@job("logistics", "dws_trans_shift_trans_finish_nd")
def ads_shift_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _report(wh.at("dws_trans_shift_trans_finish_nd", dt).select(
        "recent_days", "shift_id", *TRIP, "trans_finish_order_count"), dt)


@job("logistics", "dws_trans_org_receive_1d", "dws_trans_org_receive_nd", "dws_trans_dispatch_1d",
     "dws_trans_dispatch_nd")
def ads_trans_order_stats(wh: Warehouse, dt: str) -> DataFrame:
    received = _summed(wh, dt, "dws_trans_org_receive_1d", "dws_trans_org_receive_nd", [],
                       {"receive_order_count": "order_count", "receive_order_amount": "order_amount"})
    dispatched = _summed(wh, dt, "dws_trans_dispatch_1d", "dws_trans_dispatch_nd", [],
                         {"dispatch_order_count": "order_count", "dispatch_order_amount": "order_amount"})
    return _report(metric_merge([received, dispatched], ["recent_days"],
                                ["receive_order_count", "receive_order_amount", "dispatch_order_count",
                                 "dispatch_order_amount"]), dt)


@job("logistics", "dws_trans_dispatch_td", "dws_trans_bound_finish_td")
def ads_trans_order_stats_td(wh: Warehouse, dt: str) -> DataFrame:
    """Waybills under way: dispatched less finished."""
    return _report(signed_balance(
        wh.at("dws_trans_dispatch_td", dt), wh.at("dws_trans_bound_finish_td", dt), [],
        {"bounding_order_count": "order_count", "bounding_order_amount": "order_amount"}), dt)


@job("logistics", "dws_trans_org_truck_model_type_trans_finish_1d", "dws_trans_shift_trans_finish_nd")
def ads_trans_stats(wh: Warehouse, dt: str) -> DataFrame:
    one = wh.at("dws_trans_org_truck_model_type_trans_finish_1d", dt).select(*TRIP)
    nd = wh.at("dws_trans_shift_trans_finish_nd", dt).select("recent_days", *TRIP)
    return _report(one_day(_one_and_n(one, nd), ["recent_days"], _same(*TRIP)), dt)


@job("logistics", "dws_trans_shift_trans_finish_nd")
def ads_truck_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _report(_trip_means(one_day(
        wh.at("dws_trans_shift_trans_finish_nd", dt),
        ["recent_days", "truck_model_type", "truck_model_type_name"], _same(*TRIP))), dt)
