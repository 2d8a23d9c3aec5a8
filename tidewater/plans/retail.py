"""E-commerce warehouse: dimensions, facts, roll-ups and reports."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import mask_email, mask_name, mask_phone, money, ratio, rule_text
from tidewater.operators.dims import scd2_init, scd2_merge, scd2_reopen
from tidewater.operators.facts import accumulating_snapshot
from tidewater.operators.joins import attach, decode, flatten_star
from tidewater.operators.reports import (
    active_users,
    churned,
    interval_avg,
    page_path,
    repeat_rate,
    returned,
)
from tidewater.operators.rollups import (
    distinct_count,
    incremental_to_date,
    n_day_columns,
    n_day_entities,
    one_day,
    to_date,
    unpivot_days,
)
from tidewater.operators.sequences import consecutive_days, top_k
from tidewater.operators.sets import collect_structs, combine_scalars, union_distinct
from tidewater.plans.warehouse import DAY, Intervals, Warehouse, Window, job

CATEGORY = ["category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name"]
BRAND = ["tm_id", "tm_name"]
SKU = ["sku_name", *CATEGORY, *BRAND]
PROVINCE = ["province_name", "area_code", "iso_code", "iso_3166_2"]
ORDER_SUMS = {
    "order_count": "order_count_1d",
    "order_num": "order_num_1d",
    "order_original_amount": "order_original_amount_1d",
    "activity_reduce_amount": "activity_reduce_amount_1d",
    "coupon_reduce_amount": "coupon_reduce_amount_1d",
    "order_total_amount": "order_total_amount_1d",
}


def _rows() -> Column:
    return F.count(F.lit(1))


def _zero(name: str) -> Column:
    return F.sum(F.coalesce(F.col(name), F.lit(0)))


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _stamp(df: DataFrame, dt: str | None) -> DataFrame:
    """Snapshot tables carry the run day when there is one."""
    return df if dt is None else df.withColumn("dt", F.lit(dt).cast("date"))


def _report(df: DataFrame, dt: str) -> DataFrame:
    """Reports lead with their day."""
    return df.select(F.lit(dt).cast("date").alias("dt"), *[c for c in df.columns if c != "dt"])


# ---- dimensions


def _sku_names(wh: Warehouse, dt: str | None) -> DataFrame:
    """Skus with category path and brand."""
    sku = wh.scan("ods_sku_info", dt).select(
        "id", "price", "sku_name", "sku_desc", "weight", F.col("is_sale").cast("boolean").alias("is_sale"),
        "spu_id", "category3_id", "tm_id", "create_time")
    return flatten_star(sku, [
        (wh.scan("ods_base_category3", dt), {"category3_id": "id"},
         {"category3_name": "name", "category2_id": "category2_id"}),
        (wh.scan("ods_base_category2", dt), {"category2_id": "id"},
         {"category2_name": "name", "category1_id": "category1_id"}),
        (wh.scan("ods_base_category1", dt), {"category1_id": "id"}, {"category1_name": "name"}),
        (wh.scan("ods_base_trademark", dt), {"tm_id": "id"}, {"tm_name": "tm_name"}),
    ])


def _sku(wh: Warehouse, dt: str | None) -> DataFrame:
    """The stored sku dimension; without one, only the part the roll-ups need, not the attribute arrays."""
    return wh.snapshot("dim_sku_full", dt) if wh.stored("dim_sku_full") else _sku_names(wh, dt)


@job("retail", "ods_sku_info", "ods_spu_info", "ods_base_category3", "ods_base_category2", "ods_base_category1",
     "ods_base_trademark", "ods_sku_attr_value", "ods_sku_sale_attr_value")
def dim_sku_full(wh: Warehouse, dt: str | None) -> DataFrame:
    """Skus with product, category path, brand and the arrays of their attributes."""

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    attrs = collect_structs(
        wh.scan("ods_sku_attr_value", dt), "sku_id",
        {"attr_id": text("attr_id"), "value_id": text("value_id"), "attr_name": "attr_name",
         "value_name": "value_name"}, "attrs")
    sale_attrs = collect_structs(
        wh.scan("ods_sku_sale_attr_value", dt), "sku_id",
        {"sale_attr_id": text("sale_attr_id"), "sale_attr_value_id": text("sale_attr_value_id"),
         "sale_attr_name": "sale_attr_name", "sale_attr_value_name": "sale_attr_value_name"}, "sale_attrs")
    star = flatten_star(_sku_names(wh, dt), [
        (wh.scan("ods_spu_info", dt), {"spu_id": "id"}, {"spu_name": "spu_name"}),
        (attrs, {"id": "sku_id"}, {"attrs": "attrs"}),
        (sale_attrs, {"id": "sku_id"}, {"sale_attrs": "sale_attrs"}),
    ])
    columns = ["id", "price", "sku_name", "sku_desc", "weight", "is_sale", "spu_id", "spu_name", "category3_id",
               "category3_name", "category2_id", "category2_name", "category1_id", "category1_name", "tm_id",
               "tm_name", "attrs", "sale_attrs", "create_time"]
    return _stamp(star.select(*columns), dt)


@job("retail", "ods_coupon_info", "ods_base_dic")
def dim_coupon_full(wh: Warehouse, dt: str | None) -> DataFrame:
    coupon = wh.scan("ods_coupon_info", dt).withColumns({
        "coupon_type_code": F.col("coupon_type").cast("string"),
        "range_type_code": F.col("range_type").cast("string"),
    })
    coupon = coupon.withColumn("benefit_rule", rule_text(F.col("coupon_type_code"), "32"))
    dic = wh.snapshot("ods_base_dic", dt)
    coupon = decode(coupon, "coupon_type_code", dic, "32", "coupon_type_name")
    coupon = decode(coupon, "range_type_code", dic, "33", "range_type_name")
    columns = ["id", "coupon_name", "coupon_type_code", "coupon_type_name", "condition_amount", "condition_num",
               "activity_id", "benefit_amount", "benefit_discount", "benefit_rule", "create_time",
               "range_type_code", "range_type_name", "limit_num", "taken_count", "start_time", "end_time",
               "operate_time", "expire_time"]
    return _stamp(coupon.select(*columns), dt)


@job("retail", "ods_activity_rule", "ods_activity_info", "ods_base_dic")
def dim_activity_full(wh: Warehouse, dt: str | None) -> DataFrame:
    rule = wh.scan("ods_activity_rule", dt).withColumnRenamed("id", "activity_rule_id")
    info = wh.scan("ods_activity_info", dt)
    wide = attach(rule, info, {"activity_id": "id"},
                  _same("activity_name", "activity_desc", "start_time", "end_time", "create_time"))
    wide = wide.withColumn("activity_type_code", F.col("activity_type").cast("string"))
    wide = decode(wide, "activity_type_code", wh.snapshot("ods_base_dic", dt), "31", "activity_type_name")
    wide = wide.withColumn("benefit_rule", rule_text(F.col("activity_type_code"), "31"))
    columns = ["activity_rule_id", "activity_id", "activity_name", "activity_type_code", "activity_type_name",
               "activity_desc", "start_time", "end_time", "create_time", "condition_amount", "condition_num",
               "benefit_amount", "benefit_discount", "benefit_rule", "benefit_level"]
    return _stamp(wide.select(*columns), dt)


@job("retail", "ods_base_province", "ods_base_region")
def dim_province_full(wh: Warehouse, dt: str | None) -> DataFrame:
    province = wh.scan("ods_base_province", dt).select(
        "id", F.col("name").alias("province_name"), "area_code", "iso_code", "iso_3166_2", "region_id")
    return _stamp(attach(province, wh.scan("ods_base_region", dt), {"region_id": "id"},
                         {"region_name": "region_name"}), dt)


def _masked_users(users: DataFrame, style: str) -> DataFrame:
    return users.withColumns({
        "name": mask_name(F.col("name")),
        "phone_num": mask_phone(F.col("phone_num"), style),
        "email": mask_email(F.col("email"), style),
    })


USER = ["id", "name", "phone_num", "email", "user_level", "birthday", "gender", "create_time", "operate_time"]


@job("retail", "ods_user_info")
def dim_user_zip_init(wh: Warehouse, dt: str | None) -> DataFrame:
    """First load of the user history: masked users, open interval."""
    users = _masked_users(wh.scan("ods_user_info", dt).select(*USER), "short")
    return scd2_init(users, F.lit(dt).cast("date"))


#: The history of users: closed versions by their last day; a run reads the open ones and the changes of its days.
USER_HISTORY = {"reads": {"ods_user_change": Window(day="effective_date")}, "intervals": Intervals(scd2_reopen, "start_date")}


@job("retail", "ods_user_info", "ods_user_change", **USER_HISTORY)
def dim_user_zip(wh: Warehouse, dt: str | None) -> DataFrame:
    """User history after merging changed users; raw values are masked before the merge, stored ones never again.

    The first run loads the users as of the warehouse's ``start``; later runs build on the versions open before them.
    """
    open_rows = wh.before("dim_user_zip")
    if open_rows is None:
        if wh.start is None:
            raise ValueError("the first load of dim_user_zip needs a warehouse with a start day")
        open_rows = wh.run("dim_user_zip_init", wh.start)
    changes = _masked_users(wh.scan("ods_user_change", dt), "middle")
    return scd2_merge(open_rows, changes, "id", "effective_date", ["operate_time", "change_id"])


# ---- facts


def _day(time: str) -> Column:
    return F.to_date(F.col(time))


def _order_lines(wh: Warehouse, dt: str | None) -> DataFrame:
    """Detail lines with original amount, activity and coupon."""
    lines = wh.scan("ods_order_detail", dt).withColumn("sku_num", F.col("sku_num").cast("bigint"))
    lines = lines.withColumns({
        "split_original_amount": money(F.col("sku_num") * F.col("order_price")),
        "split_activity_amount": F.coalesce("split_activity_amount", F.lit(0)),
        "split_coupon_amount": F.coalesce("split_coupon_amount", F.lit(0)),
    })
    return flatten_star(lines, [
        (wh.scan("ods_order_detail_activity", dt), {"id": "order_detail_id"},
         _same("activity_id", "activity_rule_id")),
        (wh.scan("ods_order_detail_coupon", dt), {"id": "order_detail_id"}, _same("coupon_id")),
    ])


@job("retail", "ods_cart_info", reads={"ods_cart_info": DAY})
def dwd_trade_cart_add_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return wh.scan("ods_cart_info", dt).select(
        "id", "user_id", "sku_id", _day("create_time").alias("date_id"), "create_time", "sku_num", "dt")


@job("retail", "ods_order_detail", "ods_order_info", "ods_order_detail_activity", "ods_order_detail_coupon",
     reads={"ods_order_detail": DAY})
def dwd_trade_order_detail_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    fact = attach(_order_lines(wh, dt), wh.scan("ods_order_info", dt), {"order_id": "id"},
                  _same("user_id", "province_id"))
    return fact.withColumn("date_id", _day("create_time")).select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount", "dt")


@job("retail", "ods_order_detail", "ods_payment_info", "ods_order_info", "ods_order_detail_activity",
     "ods_order_detail_coupon", "ods_base_dic", reads={"ods_payment_info": DAY})
def dwd_trade_pay_detail_suc_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    """Paid lines; the fact's day is the payment day, its lines may have been ordered on earlier days."""
    payment = wh.scan("ods_payment_info", dt).withColumnRenamed("dt", "pay_dt")
    lines = _order_lines(wh, None).drop("dt")
    fact = attach(lines, payment, {"order_id": "order_id"},
                  {**_same("user_id", "payment_type", "callback_time"), "dt": "pay_dt"}, how="inner")
    fact = attach(fact, wh.scan("ods_order_info"), {"order_id": "id"}, _same("province_id"))
    fact = decode(fact, "payment_type", wh.snapshot("ods_base_dic", dt), "11", "payment_type_name")
    return fact.withColumn("date_id", _day("callback_time")).select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "payment_type", "payment_type_name", "date_id", "callback_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"), "dt")


@job("retail", "ods_cart_info", reads={"ods_cart_info": DAY})
def dwd_trade_cart_full(wh: Warehouse, dt: str | None) -> DataFrame:
    return wh.scan("ods_cart_info", dt).where(F.col("is_ordered") == "0").select(
        "id", "user_id", "sku_id", "sku_name", "sku_num", "dt")


@job("retail", "ods_order_info", "ods_payment_info", "ods_order_status_log",
     milestones=("payment_date_id", "finish_date_id"))
def dwd_trade_trade_flow_acc(wh: Warehouse, dt: str | None) -> DataFrame:
    """One row per order with its order, payment and finish time."""
    finished = wh.scan("ods_order_status_log").where(F.col("order_status") == "1004")
    flow = accumulating_snapshot(wh.scan("ods_order_info", dt), "id", [
        (wh.scan("ods_payment_info"), "order_id",
         {"payment_time": "callback_time", "payment_amount": "total_amount"}),
        (finished, "order_id", {"finish_time": "operate_time"}),
    ])
    return flow.select(
        F.col("id").alias("order_id"), "user_id", "province_id", _day("create_time").alias("order_date_id"),
        F.col("create_time").alias("order_time"), _day("payment_time").alias("payment_date_id"), "payment_time",
        _day("finish_time").alias("finish_date_id"), "finish_time", "original_total_amount",
        "activity_reduce_amount", "coupon_reduce_amount", "total_amount",
        F.coalesce("payment_amount", F.lit(0)).alias("payment_amount"), "dt")


@job("retail", "ods_coupon_use", reads={"ods_coupon_use": DAY})
def dwd_tool_coupon_used_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return wh.scan("ods_coupon_use", dt).select(
        "id", "coupon_id", "user_id", "order_id", _day("get_time").alias("date_id"),
        F.col("used_time").alias("payment_time"), _day("get_time").alias("dt"))


@job("retail", "ods_favor_info", reads={"ods_favor_info": DAY})
def dwd_interaction_favor_add_inc(wh: Warehouse, dt: str | None) -> DataFrame:
    return wh.scan("ods_favor_info", dt).select(
        "id", "user_id", "sku_id", _day("create_time").alias("date_id"), "create_time", "dt")


# ---- one-day and n-day roll-ups



def _order_measures() -> dict[str, Column]:
    return {
        "order_num_1d": F.sum("sku_num"),
        "order_original_amount_1d": F.sum("split_original_amount"),
        "activity_reduce_amount_1d": _zero("split_activity_amount"),
        "coupon_reduce_amount_1d": _zero("split_coupon_amount"),
        "order_total_amount_1d": F.sum("split_total_amount"),
    }


@job("retail", "dwd_trade_order_detail_inc", "dim_sku_full", reads={"dwd_trade_order_detail_inc": DAY})
def dws_trade_user_sku_order_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    """Without a day this is the history load, with a day the daily load."""
    daily = one_day(wh.scan("dwd_trade_order_detail_inc", dt), ["dt", "user_id", "sku_id"],
                    {"order_count_1d": _rows(), **_order_measures()})
    return attach(daily, _sku(wh, dt), {"sku_id": "id"}, _same(*SKU))


@job("retail", "dwd_trade_order_detail_inc", reads={"dwd_trade_order_detail_inc": DAY})
def dws_trade_user_order_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return distinct_count(wh.scan("dwd_trade_order_detail_inc", dt), ["dt", "user_id"], "order_id",
                          "order_count_1d", _order_measures())


@job("retail", "dwd_trade_cart_add_inc", reads={"dwd_trade_cart_add_inc": DAY})
def dws_trade_user_cart_add_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return one_day(wh.scan("dwd_trade_cart_add_inc", dt), ["dt", "user_id"],
                   {"cart_add_count_1d": _rows(), "cart_add_num_1d": "sku_num"})


@job("retail", "dwd_trade_pay_detail_suc_inc", reads={"dwd_trade_pay_detail_suc_inc": DAY})
def dws_trade_user_payment_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return distinct_count(wh.scan("dwd_trade_pay_detail_suc_inc", dt), ["dt", "user_id"], "order_id",
                          "payment_count_1d",
                          {"payment_num_1d": F.sum("sku_num"), "payment_amount_1d": F.sum("split_payment_amount")})


@job("retail", "dwd_trade_order_detail_inc", "dim_province_full", reads={"dwd_trade_order_detail_inc": DAY})
def dws_trade_province_order_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    measures = {k: v for k, v in _order_measures().items() if k != "order_num_1d"}
    daily = distinct_count(wh.scan("dwd_trade_order_detail_inc", dt), ["dt", "province_id"], "order_id",
                           "order_count_1d", measures)
    return attach(daily, wh.snapshot("dim_province_full", dt), {"province_id": "id"}, _same(*PROVINCE))


@job("retail", "dwd_tool_coupon_used_inc", "dim_coupon_full", reads={"dwd_tool_coupon_used_inc": DAY})
def dws_tool_user_coupon_coupon_used_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    daily = one_day(wh.scan("dwd_tool_coupon_used_inc", dt), ["dt", "user_id", "coupon_id"],
                    {"used_count_1d": _rows()})
    return attach(daily, wh.snapshot("dim_coupon_full", dt), {"coupon_id": "id"},
                  _same("coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule"))


@job("retail", "dwd_interaction_favor_add_inc", "dim_sku_full", reads={"dwd_interaction_favor_add_inc": DAY})
def dws_interaction_sku_favor_add_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    daily = one_day(wh.scan("dwd_interaction_favor_add_inc", dt), ["dt", "sku_id"], {"favor_add_count_1d": _rows()})
    return attach(daily, _sku(wh, dt), {"sku_id": "id"}, _same(*SKU))


@job("retail", "dwd_traffic_page_view_inc", reads={"dwd_traffic_page_view_inc": DAY})
def dws_traffic_session_page_view_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return one_day(wh.scan("dwd_traffic_page_view_inc", dt),
                   ["dt", "session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel"],
                   {"during_time_1d": "during_time", "page_count_1d": _rows()})


@job("retail", "dwd_traffic_page_view_inc", reads={"dwd_traffic_page_view_inc": DAY})
def dws_traffic_page_visitor_page_view_1d(wh: Warehouse, dt: str | None) -> DataFrame:
    return one_day(wh.scan("dwd_traffic_page_view_inc", dt),
                   ["dt", "mid_id", "brand", "model", "operate_system", "page_id"],
                   {"during_time_1d": "during_time", "view_count_1d": _rows()})


@job("retail", "dws_trade_user_sku_order_1d")
def dws_trade_user_sku_order_nd(wh: Warehouse, dt: str) -> DataFrame:
    return n_day_columns(wh.table("dws_trade_user_sku_order_1d"), dt, [7, 30], ["user_id", "sku_id", *SKU], ORDER_SUMS)


@job("retail", "dws_trade_province_order_1d")
def dws_trade_province_order_nd(wh: Warehouse, dt: str) -> DataFrame:
    sums = {k: v for k, v in ORDER_SUMS.items() if k != "order_num"}
    return n_day_columns(wh.table("dws_trade_province_order_1d"), dt, [7, 30], ["province_id", *PROVINCE], sums)


@job("retail", "dws_trade_user_order_1d")
def dws_trade_user_order_td(wh: Warehouse, dt: str) -> DataFrame:
    """Orders to date: the table of the day before plus the day, or the whole history where there is none."""

    def state(rows: DataFrame) -> DataFrame:
        return to_date(rows, ["user_id"], {
            "order_date_first": F.min("dt"), "order_date_last": F.max("dt"),
            **{f"{out}_td": F.sum(src) for out, src in ORDER_SUMS.items()}})

    old = wh.before("dws_trade_user_order_td")
    if old is None:
        return state(wh.table("dws_trade_user_order_1d").where(F.col("dt") <= F.lit(dt).cast("date")))
    return incremental_to_date(old, state(wh.scan("dws_trade_user_order_1d", dt)), "user_id", "order_date_first",
                               "order_date_last", [f"{out}_td" for out in ORDER_SUMS])


@job("retail", "dwd_user_login_inc")
def dws_user_user_login_td(wh: Warehouse, dt: str) -> DataFrame:
    """Logins to date: the table of the day before plus the day, or the whole history where there is none."""

    def state(rows: DataFrame) -> DataFrame:
        return one_day(rows, ["user_id"], {
            "login_date_first": F.min("dt"), "login_date_last": F.max("dt"), "login_count_td": _rows()})

    old = wh.before("dws_user_user_login_td")
    if old is None:
        return state(wh.table("dwd_user_login_inc").where(F.col("dt") <= F.lit(dt).cast("date")))
    return incremental_to_date(old, state(wh.scan("dwd_user_login_inc", dt)), "user_id", "login_date_first",
                               "login_date_last", "login_count_td")


# ---- reports


@job("retail", "dws_traffic_session_page_view_1d")
def ads_traffic_stats_by_channel(wh: Warehouse, dt: str) -> DataFrame:
    sessions = wh.table("dws_traffic_session_page_view_1d")
    rows = n_day_entities(sessions, dt, [1, 7, 30], ["channel"], "mid_id", "uv_count", {
        "__duration": F.col("during_time_1d"), "__pages": F.col("page_count_1d"), "__sessions": F.lit(1),
        "__bounced": F.when(F.col("page_count_1d") == 1, 1).otherwise(0)})
    n = F.col("__sessions")
    return _report(rows.select(
        "recent_days", "channel", "uv_count",
        F.floor(F.try_divide(F.col("__duration"), n * 1000)).cast("bigint").alias("avg_duration_sec"),
        F.floor(F.try_divide(F.col("__pages"), n)).cast("bigint").alias("avg_page_count"),
        n.cast("bigint").alias("sv_count"), ratio(F.col("__bounced"), n).alias("bounce_rate")), dt)


@job("retail", "dwd_traffic_page_view_inc")
def ads_page_path(wh: Warehouse, dt: str) -> DataFrame:
    views = wh.scan("dwd_traffic_page_view_inc", dt)
    return _report(page_path(views, ["session_id"], ["view_time", "view_id"], "page_id",
                             F.date_trunc("minute", F.col("view_time"))), dt)


@job("retail", "dws_user_user_login_td")
def ads_user_change(wh: Warehouse, dt: str) -> DataFrame:
    yesterday = str(date.fromisoformat(dt) - timedelta(days=1))
    today = wh.at("dws_user_user_login_td", dt)
    previous = wh.at("dws_user_user_login_td", yesterday)
    return _report(combine_scalars([churned(today, dt), returned(today, previous, dt)]), dt)


@job("retail", "dws_user_user_login_td")
def ads_user_stats(wh: Warehouse, dt: str) -> DataFrame:
    return _report(active_users(wh.at("dws_user_user_login_td", dt), dt, [1, 7, 30]), dt)


@job("retail", "dws_traffic_page_visitor_page_view_1d", "dws_trade_user_cart_add_1d", "dws_trade_user_order_1d",
     "dws_trade_user_payment_1d")
def ads_user_action(wh: Warehouse, dt: str) -> DataFrame:
    """Users who reached the home page, a detail page, the cart, an order and a payment."""
    pages = wh.at("dws_traffic_page_visitor_page_view_1d", dt)

    def visitors(page: str) -> Column:
        return F.count(F.when(F.col("page_id") == page, 1))

    def users(table: str, out: str) -> DataFrame:
        return wh.at(table, dt).agg(_rows().alias(out))

    return _report(combine_scalars([
        pages.agg(visitors("home").alias("home_count"), visitors("good_detail").alias("good_detail_count")),
        users("dws_trade_user_cart_add_1d", "cart_count"),
        users("dws_trade_user_order_1d", "order_count"),
        users("dws_trade_user_payment_1d", "payment_count")]), dt)


@job("retail", "dws_trade_user_order_1d")
def ads_order_continuously_user_count(wh: Warehouse, dt: str) -> DataFrame:
    day = F.lit(dt).cast("date")
    week = wh.table("dws_trade_user_order_1d").where((F.col("dt") >= F.date_sub(day, 6)) & (F.col("dt") <= day))
    users = consecutive_days(week, "user_id", "dt", 3)
    return _report(users.agg(F.lit(7).alias("recent_days"), _rows().alias("order_continuously_user_count")), dt)


@job("retail", "dws_trade_user_sku_order_nd")
def ads_repeat_purchase_by_tm(wh: Warehouse, dt: str) -> DataFrame:
    rate = repeat_rate(wh.at("dws_trade_user_sku_order_nd", dt), "user_id", BRAND, "order_count_30d",
                       "order_repeat_rate")
    return _report(rate.select(F.lit(30).alias("recent_days"), "*"), dt)


def _orders_by(wh: Warehouse, dt: str, keys: list[str]) -> DataFrame:
    """Orders and buyers per key for 1, 7 and 30 days, from one pass over the daily table."""
    rows = n_day_entities(wh.table("dws_trade_user_sku_order_1d"), dt, [1, 7, 30], keys, "user_id",
                          "order_user_count", {"order_count": F.col("order_count_1d")})
    return _report(rows.select("recent_days", *keys, "order_count", "order_user_count"), dt)


@job("retail", "dws_trade_user_sku_order_1d")
def ads_order_stats_by_tm(wh: Warehouse, dt: str) -> DataFrame:
    return _orders_by(wh, dt, BRAND)


@job("retail", "dws_trade_user_sku_order_1d")
def ads_order_stats_by_cate(wh: Warehouse, dt: str) -> DataFrame:
    return _orders_by(wh, dt, CATEGORY)


@job("retail", "dwd_trade_cart_full", "dim_sku_full")
def ads_sku_cart_num_top3_by_cate(wh: Warehouse, dt: str) -> DataFrame:
    cart = one_day(wh.scan("dwd_trade_cart_full", dt), ["sku_id"], {"cart_num": "sku_num"})
    named = attach(cart, _sku(wh, dt), {"sku_id": "id"}, _same("sku_name", *CATEGORY))
    top = top_k(named, ["category1_id", "category2_id", "category3_id"], [F.col("cart_num").desc()], 3)
    return _report(top.select(*CATEGORY, "sku_id", "sku_name", "cart_num", "rk"), dt)


@job("retail", "dws_interaction_sku_favor_add_1d")
def ads_sku_favor_count_top3_by_tm(wh: Warehouse, dt: str) -> DataFrame:
    favor = wh.at("dws_interaction_sku_favor_add_1d", dt)
    top = top_k(favor, ["tm_id"], [F.col("favor_add_count_1d").desc()], 3)
    return _report(top.select(*BRAND, "sku_id", "sku_name", "favor_add_count_1d", "rk"), dt)


@job("retail", "dwd_trade_trade_flow_acc")
def ads_order_to_pay_interval_avg(wh: Warehouse, dt: str) -> DataFrame:
    """Orders paid on the day, whenever they were placed."""
    paid = wh.table("dwd_trade_trade_flow_acc").where(F.col("payment_date_id") == F.lit(dt).cast("date"))
    return _report(interval_avg(paid, "order_time", "payment_time").withColumnRenamed(
        "interval_avg", "order_to_pay_interval_avg"), dt)


@job("retail", "dws_trade_province_order_1d", "dws_trade_province_order_nd")
def ads_order_by_province(wh: Warehouse, dt: str) -> DataFrame:
    keys = ["province_id", *PROVINCE]
    one = wh.at("dws_trade_province_order_1d", dt).select(
        F.lit(1).alias("recent_days"), *keys, F.col("order_count_1d").alias("order_count"),
        F.col("order_total_amount_1d").alias("order_total_amount"))
    nd = unpivot_days(wh.at("dws_trade_province_order_nd", dt), [7, 30], ["order_count", "order_total_amount"], keys)
    return _report(union_distinct([one, nd.select(*one.columns)]), dt)
