"""Retail source tables: lines and orders as trade, parts as skus, customers as users, events as behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures.tables import Tables, big, later, tag
from tidewater.functions import money
from tidewater.plans import Warehouse

PAGES = ["home", "good_detail", "cart", "order", "payment", "mine"]


def phone(key: str):
    k = F.col(key)
    valid = F.concat(F.lit("138"), F.lpad((k % 100000000).cast("string"), 8, "0"))
    return F.when(k % 7 == 0, "999").when(k % 11 != 0, valid)


def retail_tables(t: Tables) -> dict:
    lines, orders, events = t.lineitem, t.orders, t.event_rows()
    detail_id = (big("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    price = F.col("l_extendedprice").cast("decimal(12,2)")

    def share(c: str):
        return F.nullif(price * F.col(c).cast("decimal(4,2)"), F.lit(0).cast("decimal(17,4)"))

    def order_detail() -> DataFrame:
        return lines.select(
            detail_id, F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
            F.col("l_shipdate").cast("timestamp").alias("create_time"), F.col("l_quantity").alias("sku_num"),
            price.alias("order_price"), price.alias("split_total_amount"),
            share("l_discount").alias("split_activity_amount"), share("l_tax").alias("split_coupon_amount"),
            F.to_date("l_shipdate").alias("dt"))

    def activity() -> DataFrame:
        best = big(F.round(F.max("l_discount") * 100))
        rows = lines.where("l_discount >= 0.05").groupBy(detail_id).agg(best.alias("activity_id"))
        return rows.select(F.col("id").alias("order_detail_id"), "activity_id",
                           (F.col("activity_id") * 10 + 1).alias("activity_rule_id"))

    def coupon() -> DataFrame:
        best = big(F.round(F.max("l_tax") * 100)) + 3200
        return lines.where("l_tax >= 0.04").groupBy(detail_id.alias("order_detail_id")).agg(best.alias("coupon_id"))

    def order_info() -> DataFrame:
        placed = orders.join(t.customer, orders.o_custkey == F.col("c_custkey"), "left")
        return placed.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            big("c_nationkey").alias("province_id"), F.col("o_orderdate").cast("timestamp").alias("create_time"),
            money(F.col("o_totalprice")).alias("original_total_amount"),
            money(big("o_orderkey") % 5).alias("activity_reduce_amount"),
            money(big("o_orderkey") % 3).alias("coupon_reduce_amount"),
            money(F.col("o_totalprice")).alias("total_amount"), F.to_date("o_orderdate").alias("dt"))

    def payment_info() -> DataFrame:
        paid = later("o_orderdate", F.col("o_orderkey") % 3, F.col("o_orderkey") % 3600)
        return orders.where("o_orderstatus = 'F'").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            F.concat(F.lit("110"), F.substring("o_orderpriority", 1, 1)).alias("payment_type"),
            paid.alias("callback_time"), money(F.col("o_totalprice")).alias("total_amount"),
            F.to_date(paid).alias("dt"))

    def status_log() -> DataFrame:
        code = F.when(F.col("o_orderstatus") == "F", "1004").otherwise("1001")
        return orders.select(F.col("o_orderkey").alias("order_id"), later("o_orderdate", 5).alias("operate_time"),
                             code.alias("order_status"), F.to_date(later("o_orderdate", 5)).alias("dt"))

    def dictionary() -> DataFrame:
        def group(parent: str, word: str) -> DataFrame:
            return t.region.select(
                F.concat(F.lit(f"{parent}0"), (F.col("r_regionkey") + 1).cast("string")).alias("id"),
                tag(word, "r_name").alias("dic_name"), F.lit(parent).alias("parent_code"))

        return group("11", "pay ").unionAll(group("31", "activity ")).unionAll(group("32", "coupon ")).unionAll(
            group("33", "range "))

    part = t.part

    def numbered(expr, prefix: str, **more) -> DataFrame:
        ids = part.select(big(expr).alias("id")).distinct()
        return ids.select("id", tag(prefix, "id").alias("name"), *[big(v).alias(k) for k, v in more.items()])

    def sku_info() -> DataFrame:
        return part.select(
            F.col("p_partkey").alias("id"), money(F.col("p_retailprice")).alias("price"),
            F.col("p_name").alias("sku_name"), tag("about ", "p_name").alias("sku_desc"),
            F.col("p_size").alias("weight"), (F.col("p_size") % 2).alias("is_sale"),
            (F.col("p_partkey") % 100).alias("spu_id"), big("p_size").alias("category3_id"),
            big(F.substring("p_brand", 7, 10)).alias("tm_id"), F.lit("2000-01-01").alias("create_time"))

    def trademark() -> DataFrame:
        return part.select("p_brand").distinct().select(
            big(F.substring("p_brand", 7, 10)).alias("id"), F.col("p_brand").alias("tm_name"))

    def attr_value() -> DataFrame:
        return part.select(F.col("p_partkey").alias("sku_id"), F.inline(F.array(
            F.struct(F.lit(1).alias("attr_id"), F.col("p_size").alias("value_id"), F.lit("size").alias("attr_name"),
                     F.col("p_size").cast("string").alias("value_name")),
            F.struct(F.lit(2).alias("attr_id"), (F.col("p_size") % 10).alias("value_id"),
                     F.lit("type").alias("attr_name"), F.col("p_type").alias("value_name")))))

    def sale_attr_value() -> DataFrame:
        return lines.select(
            F.col("l_partkey").alias("sku_id"), F.lit(1).alias("sale_attr_id"),
            F.col("l_returnflag").alias("sale_attr_value_id"), F.lit("flag").alias("sale_attr_name"),
            F.col("l_linestatus").alias("sale_attr_value_name"))

    def coupon_info() -> DataFrame:
        ids = lines.select((big(F.round(F.col("l_tax") * 100)) + 3200).alias("id")).distinct()
        return ids.select(
            "id", tag("coupon ", "id").alias("coupon_name"), tag("320", F.col("id") % 3 + 1).alias("coupon_type"),
            (F.col("id") % 7 * 100).alias("condition_amount"), (F.col("id") % 4 + 1).alias("condition_num"),
            (F.col("id") % 5).alias("activity_id"), (F.col("id") % 9 * 5).alias("benefit_amount"),
            (F.col("id") % 9 + 1).alias("benefit_discount"), F.lit("2000-01-01").alias("create_time"),
            tag("330", F.col("id") % 3 + 1).alias("range_type"), (F.col("id") % 10).alias("limit_num"),
            (F.col("id") % 6).alias("taken_count"), F.lit("2000-01-01").alias("start_time"),
            F.lit("2030-01-01").alias("end_time"), F.lit("2000-01-02").alias("operate_time"),
            F.lit("2031-01-01").alias("expire_time"))

    def discounts() -> DataFrame:
        return lines.select(big(F.round(F.col("l_discount") * 100)).alias("id")).distinct()

    def activity_rule() -> DataFrame:
        return discounts().select(
            (F.col("id") * 10 + 1).alias("id"), F.col("id").alias("activity_id"),
            tag("310", F.col("id") % 3 + 1).alias("activity_type"), (F.col("id") * 100).alias("condition_amount"),
            (F.col("id") % 4 + 1).alias("condition_num"), (F.col("id") * 7).alias("benefit_amount"),
            (F.col("id") % 9 + 1).alias("benefit_discount"), (F.col("id") % 3).alias("benefit_level"))

    def activity_info() -> DataFrame:
        return discounts().select(
            "id", tag("activity ", "id").alias("activity_name"), tag("about ", "id").alias("activity_desc"),
            F.lit("2000-01-01").alias("start_time"), F.lit("2030-01-01").alias("end_time"),
            F.lit("1999-12-01").alias("create_time"))

    def user_info() -> DataFrame:
        key = F.col("c_custkey")
        email = F.when(key % 5 == 0, "bad-address").otherwise(
            F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@mail.example.com")))
        return t.customer.select(
            key.alias("id"), F.col("c_name").alias("name"), phone("c_custkey").alias("phone_num"),
            email.alias("email"), F.col("c_mktsegment").alias("user_level"),
            F.date_add(F.lit("1970-01-01").cast("date"), (key % 10000).cast("int")).alias("birthday"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("gender"), F.lit("1994-01-01").alias("create_time"),
            F.lit("1994-01-01 00:00:00").alias("operate_time"))

    def user_change() -> DataFrame:
        key = F.col("o_custkey")
        changed = later("o_orderdate", 0, F.col("o_orderkey") % 86400)
        return orders.select(
            key.alias("id"), tag("User ", "o_custkey").alias("name"), phone("o_custkey").alias("phone_num"),
            F.concat(key.cast("string"), F.lit("@new.example.com")).alias("email"),
            F.col("o_orderpriority").alias("user_level"),
            F.date_add(F.lit("1970-01-01").cast("date"), (key % 10000).cast("int")).alias("birthday"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("gender"), F.lit("1994-01-01").alias("create_time"),
            F.date_format(changed, "yyyy-MM-dd HH:mm:ss").alias("operate_time"),
            F.col("o_orderkey").alias("change_id"), F.to_date("o_orderdate").alias("effective_date"))

    def page_views() -> DataFrame:
        user = F.col("user_id")
        page = F.element_at(F.array(*[F.lit(p) for p in PAGES]), (F.col("k") % 6 + 1).cast("int"))
        return events.where("event_type <> 'error'").select(
            F.concat_ws("-", "user_id", "dt").alias("session_id"), tag("m", user).alias("mid_id"),
            tag("b", user % 5).alias("brand"), tag("md", user % 7).alias("model"),
            tag("os", user % 2).alias("operate_system"), tag("v", user % 3).alias("version_code"),
            tag("ch", user % 4).alias("channel"), page.alias("page_id"),
            big(F.floor(F.col("value") * 1000)).alias("during_time"), F.col("ts").alias("view_time"),
            F.col("event_id").alias("view_id"), "dt")

    def of_type(kind: str, *columns) -> DataFrame:
        return events.where(F.col("event_type") == kind).select(F.col("event_id").alias("id"), "user_id", *columns, "dt")

    sku, made = F.col("k").alias("sku_id"), F.col("ts").alias("create_time")
    return {
        "ods_order_detail": order_detail, "ods_order_detail_activity": activity, "ods_order_detail_coupon": coupon,
        "ods_order_info": order_info, "ods_payment_info": payment_info, "ods_order_status_log": status_log,
        "ods_base_dic": dictionary, "ods_sku_info": sku_info, "ods_base_trademark": trademark,
        "ods_spu_info": lambda: numbered(F.col("p_partkey") % 100, "spu-").withColumnRenamed("name", "spu_name"),
        "ods_base_category3": lambda: numbered("p_size", "c3-", category2_id=F.col("id") % 10),
        "ods_base_category2": lambda: numbered(F.col("p_size") % 10, "c2-", category1_id=F.col("id") % 3),
        "ods_base_category1": lambda: numbered(F.col("p_size") % 10 % 3, "c1-"),
        "ods_sku_attr_value": attr_value, "ods_sku_sale_attr_value": sale_attr_value,
        "ods_coupon_info": coupon_info, "ods_activity_rule": activity_rule, "ods_activity_info": activity_info,
        "ods_base_province": lambda: t.nation.select(
            big("n_nationkey").alias("id"), F.col("n_name").alias("name"), big("n_regionkey").alias("region_id"),
            (F.col("n_nationkey") + 100).cast("string").alias("area_code"), tag("ISO-", "n_nationkey").alias("iso_code"),
            tag("XX-", "n_nationkey").alias("iso_3166_2")),
        "ods_base_region": lambda: t.region.select(big("r_regionkey").alias("id"), F.col("r_name").alias("region_name")),
        "ods_user_info": user_info, "ods_user_change": user_change,
        "dwd_traffic_page_view_inc": page_views,
        "dwd_user_login_inc": lambda: of_type("view"),
        "ods_cart_info": lambda: of_type(
            "click", sku, tag("sku ", "k").alias("sku_name"), (F.col("k") % 5 + 1).alias("sku_num"),
            F.when(F.col("value") > 10, "1").otherwise("0").alias("is_ordered"), made),
        "ods_favor_info": lambda: of_type("signup", sku, made),
        "ods_coupon_use": lambda: of_type(
            "purchase", (F.col("k") % 9 + 3200).alias("coupon_id"), F.col("event_id").alias("order_id"),
            F.col("ts").alias("get_time"), later("ts", 0, 60).alias("used_time")),
    }


def event_trade_tables(t: Tables) -> dict:
    """Trade seen from the events: every purchase is an order with one line, large ones are paid."""
    bought = t.event_rows().where("event_type = 'purchase'")
    value = money(F.col("value"))
    few = bought.where("k < 10")
    return {
        **retail_tables(t),
        "ods_order_detail": bought.select(
            F.col("event_id").alias("id"), F.col("event_id").alias("order_id"), F.col("k").alias("sku_id"),
            F.col("ts").alias("create_time"), F.lit(1).alias("sku_num"), value.alias("order_price"),
            value.alias("split_total_amount"), value.alias("split_activity_amount"),
            value.alias("split_coupon_amount"), "dt"),
        "ods_order_info": bought.select(
            F.col("event_id").alias("id"), "user_id", (F.col("user_id") % 25).alias("province_id"), "dt"),
        "ods_payment_info": bought.where("value > 20").select(
            F.col("event_id").alias("order_id"), "user_id", F.lit("1101").alias("payment_type"),
            F.col("ts").alias("callback_time"), value.alias("total_amount"), "dt"),
        "ods_order_detail_activity": few.select(
            F.col("event_id").alias("order_detail_id"), F.col("k").alias("activity_id"),
            F.col("k").alias("activity_rule_id")),
        "ods_order_detail_coupon": few.select(
            F.col("event_id").alias("order_detail_id"), F.col("k").alias("coupon_id")),
    }


def retail(t: Tables) -> Warehouse:
    return Warehouse("retail", retail_tables(t), start="1995-01-01")


def retail_from_events(t: Tables) -> Warehouse:
    return Warehouse("retail", event_trade_tables(t))
