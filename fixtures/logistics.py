"""Logistics source tables: orders as waybills, lines as cargo, trips and scans, suppliers as organisations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures.retail import phone
from fixtures.tables import Tables, big, later, tag
from tidewater.functions import money
from tidewater.plans import Warehouse

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def logistics_tables(t: Tables) -> dict:
    kept = F.lit("0").alias("is_deleted")
    supplier_name = lambda c: F.concat(F.lit("Supplier#"), F.lpad(c.cast("string"), 9, "0"))
    line_id = (big("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")

    def regions() -> DataFrame:
        none = F.lit(None).cast("bigint")
        gone = F.when(F.col("s_suppkey") % 50 == 49, "1").otherwise("0")
        top = t.region.select(big(F.col("r_regionkey") + 100).alias("id"), none.alias("parent_id"),
                              F.col("r_name").alias("name"), F.lit("Province").alias("dict_code"),
                              F.substring("r_name", 1, 2).alias("short_name"), kept)
        middle = t.nation.select(big(F.col("n_nationkey") + 1000), big(F.col("n_regionkey") + 100), "n_name",
                                 F.lit("City"), F.substring("n_name", 1, 2), kept)
        low = t.supplier.select(F.col("s_suppkey") + 10000, big(F.col("s_nationkey") + 1000),
                                tag("D-", "s_name"), F.lit("District"), F.substring("s_name", 1, 2), gone)
        return top.unionAll(middle).unionAll(low)

    def organs() -> DataFrame:
        key, level = F.col("s_suppkey"), F.when(F.col("s_suppkey") % 4 == 0, 1).otherwise(2)
        region = F.when(level == 1, big(F.col("s_nationkey") + 1000)).otherwise(key + 10000)
        return t.supplier.select(key.alias("id"), F.col("s_name").alias("org_name"), level.alias("org_level"),
                                 region.alias("region_id"), F.when(level == 2, key - key % 4).alias("org_parent_id"),
                                 kept)

    def dictionary() -> DataFrame:
        nation, n = t.nation, F.col("n_nationkey")
        codes = [
            nation.where("n_nationkey < 7").select((n + 80001).alias("id"), tag("cargo ", "n_name").alias("name"), kept),
            nation.where("n_nationkey < 5").select(n + 1101, tag("pay ", "n_name"), kept),
            nation.where("n_nationkey < 2").select(n + 1, tag("collect ", "n_name"), kept),
            nation.where("n_nationkey < 8").select(n * 10 + 60010, tag("state ", "n_name"), kept),
        ]
        out = codes[0]
        for more in codes[1:]:
            out = out.unionAll(more)
        return out

    def state():
        key = F.col("o_orderkey")
        return F.when(key % 19 == 0, "60999").when(F.col("o_orderstatus") == "F", "60080").otherwise(
            (key % 8 * 10 + 60010).cast("string"))

    def waybills() -> DataFrame:
        return headers(placed(), state(), later("o_orderdate", F.col("o_orderkey") % 4, F.col("o_orderkey") % 86400))

    def changes() -> DataFrame:
        """The log behind the waybills: a row per state a waybill passed, now and then one more update of the last."""
        key, end, j = F.col("o_orderkey"), state().cast("int"), F.col("j")
        gone, code = end == 60999, j * 10 + 60010

        def at(step):
            return later("o_orderdate", 0, step * (key % 4) * 21600 + key % 3600)

        dropped = later("o_orderdate", 2, key % 3600)
        last = F.when(gone, dropped).otherwise(at((end - 60010) / 10))
        on_path = F.when(gone, j <= 1 - key % 2).otherwise(((j != 3) & (code <= end)) | (code == end))
        log = placed().withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(9)))).where(
            F.when(j <= 7, on_path).when(j == 8, gone).otherwise(key % 5 == 0))
        moment = F.when(j <= 7, at(j)).when(j == 8, dropped).otherwise(last + F.expr("INTERVAL 2 DAYS 1 HOUR"))
        return headers(log, F.when(j <= 7, code).otherwise(end).cast("string"), moment, F.to_date(moment).alias("dt"))

    def placed() -> DataFrame:
        """Orders with their customer: joined before the log repeats them."""
        return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")

    def headers(rows: DataFrame, status, updated, *more) -> DataFrame:
        key, user = F.col("o_orderkey"), F.col("o_custkey")

        def district(c):
            return c % 25 * 4 + 1 + c % 3 + 10000

        city, province = big(F.col("c_nationkey") + 1000), big(F.col("c_nationkey") % 5 + 100)
        return rows.select(
            key.alias("id"), tag("W", "o_orderkey").alias("order_no"), status.alias("status"),
            (key % 2 + 1).cast("string").alias("collect_type"), user.alias("user_id"),
            F.concat(F.lit("110"), F.substring("o_orderpriority", 1, 1)).alias("payment_type"),
            user.alias("receiver_complex_id"), province.alias("receiver_province_id"),
            city.alias("receiver_city_id"), district(key).alias("receiver_district_id"),
            F.col("c_name").alias("receiver_name"), user.alias("sender_complex_id"),
            province.alias("sender_province_id"), city.alias("sender_city_id"),
            district(user).alias("sender_district_id"), tag("Sender ", "c_name").alias("sender_name"),
            (key % 5 + 1).alias("cargo_num"), money(F.col("o_totalprice")).alias("amount"),
            F.unix_millis(later("o_orderdate", 3)).cast("string").alias("estimate_arrive_time"),
            money(user % 1000 + F.lit(0.25)).alias("distance"),
            F.date_format(later("o_orderdate"), ISO).alias("create_time"),
            F.date_format(updated, ISO).alias("update_time"),
            F.when(key % 17 == 0, "1").otherwise("0").alias("is_deleted"), *more)

    def cargo() -> DataFrame:
        return t.lineitem.select(
            line_id, F.col("l_orderkey").alias("order_id"),
            (F.col("l_linenumber") + 80000).cast("string").alias("cargo_type"),
            big("l_quantity").alias("volume_length"), big(F.col("l_quantity") * 2).alias("volume_width"),
            big(F.col("l_quantity") * 3).alias("volume_height"), money(F.col("l_quantity")).alias("weight"),
            F.date_format(F.col("l_shipdate").cast("timestamp"), ISO).alias("create_time"),
            F.when(F.col("l_tax") == 0.08, "1").otherwise("0").alias("is_deleted"))

    def trips() -> DataFrame:
        start = F.unix_millis(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 3600000
        end = start + big("l_quantity") * 600000
        two, org = F.col("l_returnflag") != "N", F.col("l_suppkey")
        return t.lineitem.select(
            line_id, F.col("l_partkey").alias("shift_id"), (F.col("l_partkey") % 40).alias("line_id"),
            org.alias("start_org_id"), supplier_name(org).alias("start_org_name"), (org + 1).alias("end_org_id"),
            supplier_name(org + 1).alias("end_org_name"), big("l_linenumber").alias("order_num"),
            (org * 2).alias("driver1_emp_id"), tag("Driver ", org * 2).alias("driver1_name"),
            F.when(two, org * 2 + 1).alias("driver2_emp_id"),
            F.when(two, tag("Codriver ", org * 2 + 1)).alias("driver2_name"),
            (F.col("l_partkey") % 20).alias("truck_id"), tag("T", F.col("l_partkey") % 20).alias("truck_no"),
            start.cast("string").alias("actual_start_time"), end.cast("string").alias("actual_end_time"),
            money(F.col("l_quantity") * 10).alias("actual_distance"), F.to_date("l_shipdate").alias("dt"))

    def scans() -> DataFrame:
        at = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
        emp = F.col("l_suppkey") * 10
        return t.lineitem.select(
            line_id, F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("org_id"),
            at.cast("string").alias("inbound_time"), (emp + 1).alias("inbound_emp_id"),
            F.when(F.col("l_returnflag") != "N", (at + 3600000).cast("string")).alias("sort_time"),
            (emp + 2).alias("sorter_emp_id"),
            F.when(F.col("l_linestatus") == "F", (at + 7200000).cast("string")).alias("outbound_time"),
            (emp + 3).alias("outbound_emp_id"))

    def of_part(expr) -> DataFrame:
        return t.part.select(big(expr).alias("id")).distinct()

    def lines_info() -> DataFrame:
        i = F.col("id")
        return of_part(F.col("p_partkey") % 40).select(
            "id", tag("line-", "id").alias("name"), tag("L", "id").alias("line_no"),
            (i % 3).cast("string").alias("line_level"), (i % 10).alias("org_id"),
            (i % 2 + 1).alias("transport_line_type_id"), (i % 10).alias("start_org_id"),
            supplier_name(i % 10).alias("start_org_name"), ((i + 1) % 10).alias("end_org_id"),
            supplier_name((i + 1) % 10).alias("end_org_name"), ((i + 20) % 40).alias("pair_line_id"),
            money(i * 10 + F.lit(0.5)).alias("distance"), money(i * 12).alias("cost"),
            (i * 5 + 60).alias("estimated_time"), kept)

    def shifts() -> DataFrame:
        i = F.col("p_partkey")
        return t.part.select(
            i.alias("id"), (i % 40).alias("line_id"), tag("0", F.col("p_size") % 10).alias("start_time"),
            (i * 2).alias("driver1_emp_id"), (i * 2 + 1).alias("driver2_emp_id"), (i % 20).alias("truck_id"),
            (i + 1).alias("pair_shift_id"), kept)

    def trucks() -> DataFrame:
        i = F.col("id")
        return of_part(F.col("p_partkey") % 20).select(
            "id", i.alias("team_id"), tag("T", "id").alias("truck_no"), (i % 5).alias("truck_model_id"),
            tag("gps", "id").alias("device_gps_id"), tag("e", "id").alias("engine_no"),
            F.lit("2020-01-01").alias("license_registration_date"),
            F.lit("2021-01-01").alias("license_last_check_date"), F.lit("2030-01-01").alias("license_expire_date"),
            F.lit(1).alias("is_enabled"), kept)

    def models() -> DataFrame:
        i = big("r_regionkey")
        return t.region.select(
            i.alias("id"), tag("model ", "r_name").alias("model_name"), (i + 80001).alias("model_type"),
            tag("M", i).alias("model_no"), (i + 1101).alias("brand"), money(i + 8).alias("truck_weight"),
            money(i + 10).alias("load_weight"), money(i + 18).alias("total_weight"), F.lit("V").alias("eev"),
            money(i + 7).alias("boxcar_len"), money(i + 2).alias("boxcar_wd"), money(i + 3).alias("boxcar_hg"),
            (i * 5 + 90).alias("max_speed"), (i * 50 + 300).alias("oil_vol"), kept)

    def teams() -> DataFrame:
        i = big("n_nationkey")
        return t.nation.select(i.alias("id"), tag("team ", "n_name").alias("name"), tag("TM", i).alias("team_no"),
                               (i % 10).alias("org_id"), (i + 900).alias("manager_emp_id"), kept)

    key = F.col("c_custkey")

    def users() -> DataFrame:
        email = F.when(key % 5 == 0, "bad-address").otherwise(
            F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@mail.example.com")))
        return t.customer.select(
            key.alias("id"), tag("login", key).alias("login_name"), tag("nick", key).alias("nick_name"),
            tag("pw", key).alias("passwd"), F.col("c_name").alias("real_name"),
            phone("c_custkey").alias("phone_num"), email.alias("email"), F.col("c_mktsegment").alias("user_level"),
            (key % 10000).cast("string").alias("birthday"), F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
            (key * 3600000 + F.lit(1577836800000)).cast("string").alias("create_time"),
            F.when(key % 13 == 0, "1").otherwise("0").alias("is_deleted"))

    def complexes() -> DataFrame:
        placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return placed.select(
            key.alias("id"), F.col("c_name").alias("complex_name"), big(F.col("n_regionkey") + 100).alias("province_id"),
            big(F.col("n_nationkey") + 1000).alias("city_id"), big(F.col("n_nationkey") + 5000).alias("district_id"),
            tag("district ", "n_name").alias("district_name"), kept)

    return {
        "ods_base_region_info": regions, "ods_base_organ": organs, "ods_base_dic": dictionary,
        "ods_order_info": waybills, "ods_order_change": changes, "ods_order_cargo": cargo, "ods_transport_task": trips,
        "ods_order_org_bound": scans, "ods_line_base_info": lines_info, "ods_line_base_shift": shifts,
        "ods_truck_info": trucks, "ods_truck_model": models, "ods_truck_team": teams, "ods_user_info": users,
        "ods_base_complex": complexes,
        "ods_express_courier_complex": lambda: t.lineitem.join(
            t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_suppkey").alias("courier_emp_id"), F.col("o_custkey").alias("complex_id"), kept),
        "ods_express_courier": lambda: t.customer.select(
            key.alias("id"), (key + 1000).alias("emp_id"), (key % 10).alias("org_id"),
            tag("139", key).alias("working_phone"), (key % 2 + 1).alias("express_type"), kept),
        "ods_truck_driver": lambda: t.customer.select(
            key.alias("id"), (key + 500000).alias("emp_id"), (key % 10).alias("org_id"), (key % 25).alias("team_id"),
            tag("A", key % 3).alias("license_type"), F.lit("2010-01-01").alias("init_license_date"),
            F.lit("2030-01-01").alias("expire_date"), tag("N", key).alias("license_no"),
            F.lit(1).alias("is_enabled"), F.when(key % 13 == 0, "1").otherwise("0").alias("is_deleted")),
        "ods_user_address": lambda: t.customer.select(
            key.alias("id"), key.alias("user_id"), phone("c_custkey").alias("phone"),
            big(F.col("c_nationkey") % 5 + 100).alias("province_id"), big(F.col("c_nationkey") + 1000).alias("city_id"),
            big(F.col("c_nationkey") + 5000).alias("district_id"), key.alias("complex_id"),
            tag("Street ", key).alias("address"), (key % 2).cast("int").alias("is_default"),
            F.lit("2020-02-03T04:05:06Z").alias("create_time"), kept),
    }


def logistics(t: Tables) -> Warehouse:
    return Warehouse("logistics", logistics_tables(t))


def logistics_by_day(t: Tables) -> Warehouse:
    """The same with a day on every source that grows: cargo lines come with their waybill, scans on their day."""
    tables = logistics_tables(t)
    cargo, scans, waybills = tables["ods_order_cargo"], tables["ods_order_org_bound"], tables["ods_order_info"]
    placed = lambda: t.orders.select(F.col("o_orderkey").alias("order_id"), F.date_format("o_orderdate", ISO).alias("create_time"),
                                     F.to_date("o_orderdate").alias("dt"))
    return Warehouse("logistics", {
        **tables,
        "ods_order_info": lambda: waybills().withColumn("dt", F.to_date(F.substring("create_time", 1, 10))),
        "ods_order_cargo": lambda: cargo().drop("create_time").join(placed(), "order_id"),
        "ods_order_org_bound": lambda: scans().withColumn("dt", F.to_date(F.timestamp_millis(F.col("inbound_time").cast("bigint")))),
    })
