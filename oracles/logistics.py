"""Logistics queries."""

from __future__ import annotations

from oracles.retail import EMAIL, ORDER_DAY, PHONE, TIME, customer_email, phone

REG = """reg AS (
  SELECT CAST(r_regionkey + 100 AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, r_name AS name, 'Province' AS dict_code,
         substr(r_name, 1, 2) AS short_name FROM region
  UNION ALL SELECT n_nationkey + 1000, n_regionkey + 100, n_name, 'City', substr(n_name, 1, 2) FROM nation
  UNION ALL SELECT s_suppkey + 10000, s_nationkey + 1000, 'D-' || s_name, 'District', substr(s_name, 1, 2) FROM supplier
  WHERE s_suppkey % 50 <> 49)"""

ORG = """org AS (
  SELECT s_suppkey AS id, s_name AS org_name, CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 2 END AS org_level,
         CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 1000 ELSE s_suppkey + 10000 END AS region_id,
         CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey - s_suppkey % 4 END AS org_parent_id
  FROM supplier)"""

DIC = """dic AS (
  SELECT CAST(n_nationkey + 80001 AS VARCHAR) AS code, 'cargo ' || n_name AS name FROM nation WHERE n_nationkey < 7
  UNION ALL SELECT CAST(n_nationkey + 1101 AS VARCHAR), 'pay ' || n_name FROM nation WHERE n_nationkey < 5
  UNION ALL SELECT CAST(n_nationkey + 1 AS VARCHAR), 'collect ' || n_name FROM nation WHERE n_nationkey < 2
  UNION ALL SELECT CAST(n_nationkey * 10 + 60010 AS VARCHAR), 'state ' || n_name FROM nation WHERE n_nationkey < 8)"""

# An organisation with the city and province above it, resolved by level.
PLACED = f"""{REG}, {ORG}, place AS (
  SELECT org.id AS org_id, org.org_name,
         CASE WHEN org_level = 1 THEN a.id ELSE b.id END AS city_id,
         CASE WHEN org_level = 1 THEN a.name ELSE b.name END AS city_name,
         CASE WHEN org_level = 1 THEN b.id ELSE c.id END AS province_id,
         CASE WHEN org_level = 1 THEN b.name ELSE c.name END AS province_name
  FROM org LEFT JOIN reg a ON org.region_id = a.id LEFT JOIN reg b ON a.parent_id = b.id
  LEFT JOIN reg c ON b.parent_id = c.id)"""

DISTRICT = "CAST({0} % 25 * 4 + 1 + {0} % 3 + 10000 AS BIGINT)"

WAY = f"""way AS (
  SELECT o_orderkey AS order_id, 'W' || o_orderkey AS order_no,
         CASE WHEN o_orderkey % 19 = 0 THEN '60999' WHEN o_orderstatus = 'F' THEN '60080'
              ELSE CAST(o_orderkey % 8 * 10 + 60010 AS VARCHAR) END AS status,
         CAST(o_orderkey % 2 + 1 AS VARCHAR) AS collect_type, o_custkey AS user_id,
         '110' || substr(o_orderpriority, 1, 1) AS payment_type, o_custkey AS receiver_complex_id,
         CAST(c_nationkey % 5 + 100 AS BIGINT) AS receiver_province_id, CAST(c_nationkey + 1000 AS BIGINT) AS receiver_city_id,
         {DISTRICT.format("o_orderkey")} AS receiver_district_id, substr(c_name, 1, 1) || '*' AS receiver_name,
         o_custkey AS sender_complex_id, CAST(c_nationkey % 5 + 100 AS BIGINT) AS sender_province_id,
         CAST(c_nationkey + 1000 AS BIGINT) AS sender_city_id, {DISTRICT.format("o_custkey")} AS sender_district_id,
         'S*' AS sender_name, o_orderkey % 5 + 1 AS cargo_num, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         strftime(o_orderdate + INTERVAL 3 DAY, {TIME}) AS estimate_arrive_time,
         CAST(o_custkey % 1000 + 0.25 AS DOUBLE) AS distance,
         o_orderdate + to_days(CAST(o_orderkey % 4 AS INTEGER)) + to_seconds(o_orderkey % 86400) AS updated,
         o_orderdate AS placed
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 17 <> 0),
cargo AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, CAST(l_linenumber + 80000 AS VARCHAR) AS cargo_type,
         CAST(l_quantity AS BIGINT) AS volume_length, CAST(l_quantity * 2 AS BIGINT) AS volume_width,
         CAST(l_quantity * 3 AS BIGINT) AS volume_height, l_quantity AS weight, l_shipdate AS created
  FROM lineitem WHERE l_tax <> 0.08)"""

CARGO_COLS = "cargo.id, order_id, cargo_type, volume_length, volume_width, volume_height, weight"
WAY_COLS = """order_no, status, collect_type, user_id, receiver_complex_id, receiver_province_id, receiver_city_id,
  receiver_district_id, receiver_name, sender_complex_id, sender_province_id, sender_city_id, sender_district_id, sender_name,
  cargo_num, CAST(amount AS DOUBLE) AS amount, estimate_arrive_time, distance"""

# The change log of the waybills: a row for every state passed, a second update of the last state for every fifth waybill.
LOG = """steps AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS j),
passed AS (
  SELECT way.order_id, CAST(60010 + 10 * j AS VARCHAR) AS code, placed + to_hours(j * (order_id % 4) * 6) + to_seconds(order_id % 3600) AS moment
  FROM way JOIN steps ON CASE WHEN status = '60999' THEN j <= 1 - order_id % 2
    ELSE (j <> 3 AND 60010 + 10 * j <= CAST(status AS INTEGER)) OR 60010 + 10 * j = CAST(status AS INTEGER) END
  UNION ALL SELECT order_id, status, placed + INTERVAL 2 DAY + to_seconds(order_id % 3600) FROM way WHERE status = '60999'),
changes AS (
  SELECT * FROM passed
  UNION ALL SELECT order_id, max(code), max(moment) + INTERVAL 2 DAY + INTERVAL 1 HOUR FROM passed WHERE order_id % 5 = 0 GROUP BY order_id),
log AS (SELECT way.* EXCLUDE (status, updated), code AS status, moment FROM changes JOIN way USING (order_id))"""

REACHED = {"order": "true", "pay": "status >= '60020' AND status <> '60999'", "cancel": "status = '60999'",
           "receive": "status >= '60030' AND status <> '60999'", "dispatch": "status >= '60050' AND status <> '60999'",
           "bound_finish": "status >= '60060' AND status <> '60999'", "deliver": "status >= '60070' AND status <> '60999'",
           "sign": "status >= '60080' AND status <> '60999'"}


def first(event: str) -> str:
    """The change with which a waybill reached an event for the first time."""
    return f"SELECT DISTINCT ON (order_id) * FROM log WHERE {REACHED[event]} ORDER BY order_id, moment, status"


def waybill_reached(where: str = "") -> str:
    events = ("pay", "receive", "dispatch", "bound_finish", "deliver", "sign", "cancel")
    reached = ", ".join(f"min(moment) FILTER ({REACHED[e]}) AS {e}" for e in events)
    times = ", ".join(f"strftime({e}, {TIME}) AS {e}" for e in events)
    return f"""WITH {WAY}, {LOG}, f AS (SELECT order_id AS id, min(placed) AS placed, {reached} FROM log {where} GROUP BY order_id)
SELECT id, strftime(placed, '%Y-%m-%d') AS placed, {times}, coalesce(strftime(least(sign, cancel), '%Y-%m-%d'), '9999-12-31') AS dt FROM f"""


def waybill_fact(event: str, time: str) -> str:
    at, of = ("created", "way") if event == "order" else ("moment", "reached")
    pay = "" if event == "order" else "payment_type, d4.name AS payment_type_name, "
    join = "" if event == "order" else "LEFT JOIN dic d4 ON payment_type = d4.code"
    return f"""WITH {DIC}, {WAY}, {LOG}, reached AS ({first(event)})
SELECT {CARGO_COLS}, {WAY_COLS}, {pay} d1.name AS cargo_type_name, d2.name AS status_name, d3.name AS collect_type_name,
  strftime({at}, {TIME}) AS {time}, strftime({at}, '%Y-%m-%d') AS dt
FROM cargo JOIN {of} USING (order_id) LEFT JOIN dic d1 ON cargo_type = d1.code LEFT JOIN dic d2 ON status = d2.code
LEFT JOIN dic d3 ON collect_type = d3.code {join}"""


TRIPS = """trip AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS shift_id, l_partkey % 40 AS line_id, l_suppkey AS start_org_id,
         'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS start_org_name, l_suppkey + 1 AS end_org_id,
         'Supplier#' || lpad(CAST(l_suppkey + 1 AS VARCHAR), 9, '0') AS end_org_name, CAST(l_linenumber AS BIGINT) AS order_num,
         l_suppkey * 2 AS driver1_emp_id, 'D*' AS driver1_name,
         CASE WHEN l_returnflag <> 'N' THEN l_suppkey * 2 + 1 END AS driver2_emp_id,
         CASE WHEN l_returnflag <> 'N' THEN 'C*' END AS driver2_name, l_partkey % 20 AS truck_id,
         md5('T' || (l_partkey % 20)) AS truck_no, l_shipdate + to_hours(l_linenumber) AS s,
         l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity AS BIGINT) * 10) AS e,
         l_quantity * 10 AS actual_distance, CAST(l_quantity AS BIGINT) * 600 AS finish_dur_sec,
         CAST(l_shipdate AS DATE) AS dt, l_partkey % 40 * 5 + 60 AS est
  FROM lineitem)"""

TRUCK = f"""truck AS (
  SELECT DISTINCT p_partkey % 20 AS id, CAST(p_partkey % 20 % 5 + 80001 AS BIGINT) AS truck_model_type,
         'cargo NATION_' || (p_partkey % 20 % 5) AS truck_model_type_name FROM part)"""

ORDER_1D = f"""{PLACED}, {DIC}, {WAY}, o0 AS (
  SELECT order_id, cargo_type, dic.name AS cargo_type_name, sender_district_id, sender_city_id, max(amount) AS amount,
         CAST(created AS DATE) AS dt
  FROM cargo JOIN way USING (order_id) LEFT JOIN dic ON cargo_type = code GROUP BY ALL),
order_1d AS (
  SELECT org.id AS org_id, org.org_name, sender_city_id AS city_id, reg.name AS city_name, cargo_type, cargo_type_name, dt,
         count(*) AS order_count, sum(amount) AS order_amount
  FROM o0 LEFT JOIN org ON sender_district_id = org.region_id LEFT JOIN reg ON sender_city_id = reg.id GROUP BY ALL)"""


def once(event: str) -> str:
    """Waybills with at least one cargo line that reached an event, one row per waybill and day."""
    return f"""(SELECT order_id, amount, sender_district_id, receiver_district_id, CAST(moment AS DATE) AS dt
  FROM (WITH {LOG} {first(event)}) WHERE order_id IN (SELECT order_id FROM cargo))"""


def org_orders(event: str, district: str, name: str) -> str:
    return f"""{name} AS (
  SELECT org.id AS org_id, org.org_name, c.id AS city_id, c.name AS city_name, p.id AS province_id, p.name AS province_name,
         x.dt, count(*) AS order_count, sum(amount) AS order_amount
  FROM {once(event)} x LEFT JOIN org ON {district} = org.region_id LEFT JOIN reg d ON org.region_id = d.id
  LEFT JOIN reg c ON d.parent_id = c.id LEFT JOIN reg p ON c.parent_id = p.id GROUP BY ALL)"""


RECEIVE = org_orders("receive", "sender_district_id", "rec")
DELIVER = org_orders("deliver", "receiver_district_id", "del")
SORT = """srt AS (
  SELECT l_suppkey AS org_id, org_name, city_id, city_name, province_id, province_name, CAST(l_shipdate AS DATE) AS dt,
         count(*) AS sort_count
  FROM lineitem LEFT JOIN place ON l_suppkey = place.org_id WHERE l_returnflag <> 'N' GROUP BY ALL)"""
DISPATCH = f"dsp AS (SELECT dt, count(*) AS order_count, sum(amount) AS order_amount FROM {once('dispatch')} GROUP BY 1)"

SHIFT_ND = f"""{TRIPS}, {TRUCK}, snd AS (
  SELECT recent_days, shift_id, city_id, city_name, start_org_id AS org_id, start_org_name AS org_name, line_id,
         CASE WHEN p_partkey IS NOT NULL THEN 'line-' || (shift_id % 40) END AS line_name, driver1_emp_id, driver1_name,
         driver2_emp_id, driver2_name, truck_model_type, truck_model_type_name, count(*) AS trans_finish_count,
         sum(actual_distance) AS trans_finish_distance, CAST(sum(finish_dur_sec) AS BIGINT) AS trans_finish_dur_sec,
         CAST(sum(order_num) AS BIGINT) AS trans_finish_order_count,
         CAST(sum(CASE WHEN finish_dur_sec > est * 60 THEN 1 ELSE 0 END) AS BIGINT) AS trans_finish_delay_count
  FROM trip JOIN (SELECT unnest([7, 30]) AS recent_days) ON dt BETWEEN {ORDER_DAY} - recent_days + 1 AND {ORDER_DAY}
  LEFT JOIN place ON start_org_id = place.org_id LEFT JOIN part ON shift_id = p_partkey LEFT JOIN truck ON truck_id = truck.id
  GROUP BY ALL)"""

TRIP = """sum(trans_finish_count) AS trans_finish_count, sum(trans_finish_distance) AS trans_finish_distance,
  sum(trans_finish_dur_sec) AS trans_finish_dur_sec"""
TRIP_OUT = """CAST(trans_finish_count AS BIGINT) AS trans_finish_count, CAST(trans_finish_distance AS DOUBLE) AS trans_finish_distance,
  CAST(trans_finish_dur_sec AS BIGINT) AS trans_finish_dur_sec"""
MEANS = """CAST(round(trans_finish_distance / trans_finish_count, 2) AS DOUBLE) AS avg_trans_finish_distance,
  CAST(floor(trans_finish_dur_sec / trans_finish_count) AS BIGINT) AS avg_trans_finish_dur_sec"""


def nd(table: str, keys: str, sums: str, days="7, 30") -> str:
    return f"""SELECT recent_days, {keys} {sums} FROM {table}, (SELECT unnest([{days}]) AS recent_days)
WHERE dt BETWEEN {ORDER_DAY} - recent_days + 1 AND {ORDER_DAY} GROUP BY ALL"""


COUNT = "CAST(sum(order_count) AS BIGINT) AS order_count"
AMOUNT = "CAST(sum(order_amount) AS DOUBLE) AS order_amount"
PLACE = "org_id, org_name, city_id, city_name, province_id, province_name"
CTYPE = "org_id, org_name, city_id, city_name, cargo_type, cargo_type_name"


def orders_and_trips(keys: str, names: list[str]) -> str:
    on = " AND ".join(f"o.{n} IS NOT DISTINCT FROM t.{n}" for n in ["recent_days", *names])
    out = ", ".join(f"coalesce(o.{n}, t.{n}) AS {n}" for n in ["recent_days", *names])
    return f"""WITH {ORDER_1D}, {SHIFT_ND},
  o AS ({nd("order_1d", keys + ",", COUNT + ", " + AMOUNT, "1, 7, 30")}),
  t1 AS (SELECT place.city_id, place.city_name, start_org_id AS org_id, start_org_name AS org_name, 1 AS trans_finish_count,
           actual_distance AS trans_finish_distance, finish_dur_sec AS trans_finish_dur_sec
         FROM trip LEFT JOIN place ON start_org_id = place.org_id WHERE dt = {ORDER_DAY}),
  tt AS (SELECT 1 AS recent_days, {keys}, trans_finish_count, trans_finish_distance, trans_finish_dur_sec FROM t1
         UNION ALL SELECT recent_days, {keys}, trans_finish_count, trans_finish_distance, trans_finish_dur_sec FROM snd),
  t AS (SELECT recent_days, {keys}, {TRIP} FROM tt GROUP BY ALL)
SELECT '2001-07-01' AS dt, {out}, order_count, order_amount, {TRIP_OUT}, {MEANS} FROM o FULL JOIN t ON {on}"""


def express(keys: str, names: list[str]) -> str:
    head = f"{keys}," if keys else ""
    r = nd("rec", head, f"{COUNT.replace('AS order_count', 'AS receive_order_count')}, "
           f"{AMOUNT.replace('AS order_amount', 'AS receive_order_amount')}", "1, 7, 30")
    d = nd("del", head, COUNT.replace("AS order_count", "AS deliver_suc_count"), "1, 7, 30")
    s = nd("srt", head, "CAST(sum(sort_count) AS BIGINT) AS sort_count", "1, 7, 30")
    keep = ["recent_days", *names]
    cols = ", ".join(keep)
    parts = (f"SELECT {cols}, receive_order_count, receive_order_amount, NULL AS deliver_suc_count, NULL AS sort_count FROM r "
             f"UNION ALL SELECT {cols}, NULL, NULL, deliver_suc_count, NULL FROM d "
             f"UNION ALL SELECT {cols}, NULL, NULL, NULL, sort_count FROM s")
    return f"""WITH {PLACED}, {WAY}, {RECEIVE}, {DELIVER}, {SORT}, r AS ({r}), d AS ({d}), s AS ({s}), u AS ({parts})
SELECT '2001-07-01' AS dt, {cols}, CAST(max(receive_order_count) AS BIGINT) AS receive_order_count,
  CAST(max(receive_order_amount) AS DOUBLE) AS receive_order_amount, CAST(max(deliver_suc_count) AS BIGINT) AS deliver_suc_count,
  CAST(max(sort_count) AS BIGINT) AS sort_count FROM u GROUP BY ALL"""


def bound(time: str, emp: str, emp_add: int, hours: int, where: str) -> str:
    at = f"l_shipdate + INTERVAL {hours} HOUR"
    return f"""SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_suppkey AS org_id,
  strftime({at}, {TIME}) AS {time}, l_suppkey * 10 + {emp_add} AS {emp}, strftime({at}, '%Y-%m-%d') AS dt
FROM lineitem WHERE {where}"""


def sql() -> dict[str, str]:
    q = {}
    q["dim_complex_full"] = """WITH c AS (
  SELECT o_custkey AS complex_id, string_agg(v, ',' ORDER BY v) AS courier_emp_ids FROM (
    SELECT DISTINCT o_custkey, CAST(l_suppkey AS VARCHAR) AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1)
SELECT c_custkey AS id, c_name AS complex_name, courier_emp_ids, CAST(n_regionkey + 100 AS BIGINT) AS province_id,
  r_name AS province_name, CAST(n_nationkey + 1000 AS BIGINT) AS city_id, n_name AS city_name,
  CAST(n_nationkey + 5000 AS BIGINT) AS district_id, 'district ' || n_name AS district_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN c ON c_custkey = complex_id"""
    q["dim_organ_full"] = f"""WITH {REG}, {ORG} SELECT org.*, reg.name AS region_name, dict_code AS region_code, p.org_name AS org_parent_name
FROM org LEFT JOIN reg ON region_id = reg.id LEFT JOIN org p ON org.org_parent_id = p.id"""
    q["dim_region_full"] = f"WITH {REG} SELECT * FROM reg"
    q["dim_express_courier_full"] = f"""WITH {DIC} SELECT c_custkey AS id, c_custkey + 1000 AS emp_id, c_custkey % 10 AS org_id,
  md5('139' || c_custkey) AS working_phone, c_custkey % 2 + 1 AS express_type, s_name AS org_name, dic.name AS express_type_name
FROM customer JOIN supplier ON c_custkey % 10 = s_suppkey JOIN dic ON code = CAST(c_custkey % 2 + 1 AS VARCHAR)"""
    q["dim_shift_full"] = f"""WITH {DIC}, x AS (SELECT *, p_partkey % 40 AS i FROM part)
SELECT p_partkey AS id, i AS line_id, 'line-' || i AS line_name, 'L' || i AS line_no, CAST(i % 3 AS VARCHAR) AS line_level,
  i % 10 AS org_id, i % 2 + 1 AS transport_line_type_id, dic.name AS transport_line_type_name, i % 10 AS start_org_id,
  'Supplier#' || lpad(CAST(i % 10 AS VARCHAR), 9, '0') AS start_org_name, (i + 1) % 10 AS end_org_id,
  'Supplier#' || lpad(CAST((i + 1) % 10 AS VARCHAR), 9, '0') AS end_org_name, (i + 20) % 40 AS pair_line_id,
  CAST(i * 10 + 0.5 AS DOUBLE) AS distance, CAST(i * 12 AS DOUBLE) AS cost, i * 5 + 60 AS estimated_time,
  '0' || (p_size % 10) AS start_time, p_partkey * 2 AS driver1_emp_id, p_partkey * 2 + 1 AS driver2_emp_id,
  p_partkey % 20 AS truck_id, p_partkey + 1 AS pair_shift_id
FROM x JOIN dic ON code = CAST(i % 2 + 1 AS VARCHAR)"""
    q["dim_truck_driver_full"] = """SELECT c_custkey AS id, c_custkey + 500000 AS emp_id, c_custkey % 10 AS org_id, c_custkey % 25 AS team_id,
  'A' || (c_custkey % 3) AS license_type, '2010-01-01' AS init_license_date, '2030-01-01' AS expire_date,
  'N' || c_custkey AS license_no, 1 AS is_enabled, s_name AS org_name, 'team ' || n_name AS team_name
FROM customer JOIN supplier ON c_custkey % 10 = s_suppkey JOIN nation ON c_custkey % 25 = n_nationkey WHERE c_custkey % 13 <> 0"""
    q["dim_truck_full"] = f"""WITH {DIC}, x AS (SELECT DISTINCT p_partkey % 20 AS id FROM part), y AS (SELECT *, id % 5 AS m FROM x)
SELECT y.id, y.id AS team_id, md5('T' || y.id) AS truck_no, m AS truck_model_id, 'gps' || y.id AS device_gps_id, 'e' || y.id AS engine_no,
  '2020-01-01' AS license_registration_date, '2021-01-01' AS license_last_check_date, '2030-01-01' AS license_expire_date,
  1 AS is_enabled, 'team ' || n_name AS team_name, 'TM' || n_nationkey AS team_no, n_nationkey % 10 AS org_id,
  n_nationkey + 900 AS manager_emp_id, 'model ' || r_name AS truck_model_name, m + 80001 AS truck_model_type, 'M' || m AS truck_model_no,
  m + 1101 AS truck_brand, CAST(m + 8 AS DOUBLE) AS truck_weight, CAST(m + 10 AS DOUBLE) AS load_weight,
  CAST(m + 18 AS DOUBLE) AS total_weight, 'V' AS eev, CAST(m + 7 AS DOUBLE) AS boxcar_len, CAST(m + 2 AS DOUBLE) AS boxcar_wd,
  CAST(m + 3 AS DOUBLE) AS boxcar_hg, m * 5 + 90 AS max_speed, m * 50 + 300 AS oil_vol, s_name AS org_name,
  d1.name AS truck_model_type_name, d2.name AS truck_brand_name
FROM y JOIN nation ON y.id = n_nationkey JOIN region ON m = r_regionkey JOIN supplier ON n_nationkey % 10 = s_suppkey
JOIN dic d1 ON d1.code = CAST(m + 80001 AS VARCHAR) JOIN dic d2 ON d2.code = CAST(m + 1101 AS VARCHAR)"""
    q["dim_user_zip"] = f"""SELECT c_custkey AS id, 'login' || c_custkey AS login_name, 'nick' || c_custkey AS nick_name,
  md5('pw' || c_custkey) AS passwd, md5(c_name) AS real_name,
  CASE WHEN regexp_matches({phone("c_custkey")}, '{PHONE}') THEN md5({phone("c_custkey")}) END AS phone_num,
  CASE WHEN regexp_matches({customer_email()}, '{EMAIL}') THEN md5({customer_email()}) END AS email, c_mktsegment AS user_level,
  CAST(DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS VARCHAR) AS birthday,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  strftime(TIMESTAMP '2020-01-01' + to_hours(c_custkey), '%Y-%m-%d') AS start_date, '9999-12-31' AS end_date
FROM customer WHERE c_custkey % 13 <> 0"""
    q["dim_user_address_zip"] = f"""SELECT c_custkey AS id, c_custkey AS user_id,
  CASE WHEN regexp_matches({phone("c_custkey")}, '{PHONE}') THEN md5({phone("c_custkey")}) END AS phone,
  CAST(c_nationkey % 5 + 100 AS BIGINT) AS province_id, CAST(c_nationkey + 1000 AS BIGINT) AS city_id,
  CAST(c_nationkey + 5000 AS BIGINT) AS district_id, c_custkey AS complex_id, 'Street ' || c_custkey AS address,
  CAST(c_custkey % 2 AS INTEGER) AS is_default, '2020-02-03 04:05:06' AS start_date, '9999-12-31' AS end_date FROM customer"""

    for table, event, time in [
        ("dwd_trade_order_detail_inc", "order", "order_time"), ("dwd_trade_pay_suc_detail_inc", "pay", "payment_time"),
        ("dwd_trade_order_cancel_detail_inc", "cancel", "cancel_time"),
        ("dwd_trans_receive_detail_inc", "receive", "receive_time"),
        ("dwd_trans_dispatch_detail_inc", "dispatch", "dispatch_time"),
        ("dwd_trans_bound_finish_detail_inc", "bound_finish", "bound_finish_time"),
        ("dwd_trans_deliver_suc_detail_inc", "deliver", "deliver_suc_time"),
        ("dwd_trans_sign_detail_inc", "sign", "sign_time"),
    ]:
        q[table] = waybill_fact(event, time)
    q["dwm_waybill_reached"] = waybill_reached()
    q["dwd_trade_order_process_inc"] = f"""WITH {DIC}, {WAY}, f AS (
  SELECT {CARGO_COLS}, {WAY_COLS}, payment_type, d4.name AS payment_type_name, d1.name AS cargo_type_name, d2.name AS status_name,
    d3.name AS collect_type_name, strftime(created, {TIME}) AS order_time, strftime(created, '%Y-%m-%d') AS start_date,
    CASE WHEN status IN ('60080', '60999') THEN strftime(updated, '%Y-%m-%d') ELSE '9999-12-31' END AS end_date
  FROM cargo JOIN way USING (order_id) LEFT JOIN dic d1 ON cargo_type = d1.code LEFT JOIN dic d2 ON status = d2.code
  LEFT JOIN dic d3 ON collect_type = d3.code LEFT JOIN dic d4 ON payment_type = d4.code)
SELECT *, end_date AS dt FROM f"""
    q["dwd_trans_trans_finish_inc"] = f"""WITH {TRIPS}
SELECT id, shift_id, line_id, start_org_id, start_org_name, end_org_id, end_org_name, order_num, driver1_emp_id, driver1_name,
  driver2_emp_id, driver2_name, truck_id, truck_no, strftime(s, {TIME}) AS actual_start_time, strftime(e, {TIME}) AS actual_end_time,
  actual_distance, finish_dur_sec, CAST(dt AS VARCHAR) AS dt,
  CASE WHEN p_partkey IS NOT NULL THEN strftime(s + to_minutes(est), {TIME}) END AS estimate_end_time
FROM trip LEFT JOIN part ON shift_id = p_partkey"""
    q["dwd_bound_inbound_inc"] = bound("inbound_time", "inbound_emp_id", 1, 0, "true")
    q["dwd_bound_sort_inc"] = bound("sort_time", "sorter_emp_id", 2, 1, "l_returnflag <> 'N'")
    q["dwd_bound_outbound_inc"] = bound("outbound_time", "outbound_emp_id", 3, 2, "l_linestatus = 'F'")

    day = "CAST(dt AS VARCHAR) AS dt"
    q["dws_trade_org_cargo_type_order_1d"] = f"""WITH {ORDER_1D} SELECT {CTYPE}, {day}, order_count,
  CAST(order_amount AS DOUBLE) AS order_amount FROM order_1d"""
    q["dws_trans_dispatch_1d"] = f"WITH {WAY}, {DISPATCH} SELECT {day}, order_count, CAST(order_amount AS DOUBLE) AS order_amount FROM dsp"
    q["dws_trans_org_deliver_suc_1d"] = f"WITH {PLACED}, {WAY}, {DELIVER} SELECT {PLACE}, {day}, order_count FROM del"
    q["dws_trans_org_receive_1d"] = f"""WITH {PLACED}, {WAY}, {RECEIVE} SELECT {PLACE}, {day}, order_count,
  CAST(order_amount AS DOUBLE) AS order_amount FROM rec"""
    q["dws_trans_org_sort_1d"] = f"WITH {PLACED}, {SORT} SELECT {PLACE}, {day}, sort_count FROM srt"
    q["dws_trans_org_truck_model_type_trans_finish_1d"] = f"""WITH {TRIPS}, {TRUCK}
SELECT start_org_id AS org_id, start_org_name AS org_name, truck_model_type, truck_model_type_name, CAST(dt AS VARCHAR) AS dt,
  count(*) AS trans_finish_count, sum(actual_distance) AS trans_finish_distance, CAST(sum(finish_dur_sec) AS BIGINT) AS trans_finish_dur_sec
FROM trip LEFT JOIN truck ON truck_id = truck.id GROUP BY ALL"""
    q["dws_trade_org_cargo_type_order_nd"] = f"WITH {ORDER_1D} {nd('order_1d', CTYPE + ',', COUNT + ', ' + AMOUNT)}"
    q["dws_trans_bound_finish_td"] = f"""WITH {WAY} SELECT count(*) AS order_count, CAST(sum(amount) AS DOUBLE) AS order_amount
FROM {once("bound_finish")} WHERE dt <= {ORDER_DAY}"""
    q["dws_trans_dispatch_nd"] = f"WITH {WAY}, {DISPATCH} {nd('dsp', '', COUNT + ', ' + AMOUNT)}"
    q["dws_trans_dispatch_td"] = f"WITH {WAY}, {DISPATCH} SELECT {COUNT}, {AMOUNT} FROM dsp WHERE dt <= {ORDER_DAY}"
    q["dws_trans_org_deliver_suc_nd"] = f"WITH {PLACED}, {WAY}, {DELIVER} {nd('del', PLACE + ',', COUNT)}"
    q["dws_trans_org_receive_nd"] = f"WITH {PLACED}, {WAY}, {RECEIVE} {nd('rec', PLACE + ',', COUNT + ', ' + AMOUNT)}"
    q["dws_trans_org_sort_nd"] = f"WITH {PLACED}, {SORT} {nd('srt', PLACE + ',', 'CAST(sum(sort_count) AS BIGINT) AS sort_count')}"
    q["dws_trans_shift_trans_finish_nd"] = f"WITH {PLACED}, {SHIFT_ND} SELECT * FROM snd"

    q["ads_city_stats"] = orders_and_trips("city_id, city_name", ["city_id", "city_name"])
    q["ads_org_stats"] = orders_and_trips("org_id, org_name", ["org_id", "org_name"])
    q["ads_driver_stats"] = f"""WITH {PLACED}, {SHIFT_ND}, d AS (
  SELECT recent_days, driver1_emp_id AS driver_emp_id, driver1_name AS driver_name, trans_finish_count,
    trans_finish_distance / CASE WHEN driver2_emp_id IS NULL THEN 1 ELSE 2 END AS trans_finish_distance,
    trans_finish_dur_sec / CASE WHEN driver2_emp_id IS NULL THEN 1 ELSE 2 END AS trans_finish_dur_sec, trans_finish_delay_count FROM snd
  UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, trans_finish_distance / 2,
    trans_finish_dur_sec / 2, trans_finish_delay_count FROM snd WHERE driver2_emp_id IS NOT NULL),
  g AS (SELECT recent_days, driver_emp_id, driver_name, {TRIP}, CAST(sum(trans_finish_delay_count) AS BIGINT) AS trans_finish_late_count
        FROM d GROUP BY ALL)
SELECT '2001-07-01' AS dt, recent_days, driver_emp_id, driver_name, CAST(trans_finish_count AS BIGINT) AS trans_finish_count,
  trans_finish_distance, CAST(trans_finish_dur_sec AS DOUBLE) AS trans_finish_dur_sec, trans_finish_late_count, {MEANS} FROM g"""
    q["ads_express_city_stats"] = express("city_id, city_name", ["city_id", "city_name"])
    q["ads_express_org_stats"] = express("org_id, org_name", ["org_id", "org_name"])
    q["ads_express_province_stats"] = express("province_id, province_name", ["province_id", "province_name"])
    q["ads_express_stats"] = f"SELECT * EXCLUDE (receive_order_count, receive_order_amount) FROM ({express('', [])})"
    report = f"WITH {PLACED}, {SHIFT_ND} SELECT '2001-07-01' AS dt, recent_days"
    trips = TRIP.replace("sum(trans_finish_count)", "CAST(sum(trans_finish_count) AS BIGINT)").replace(
        "sum(trans_finish_dur_sec)", "CAST(sum(trans_finish_dur_sec) AS BIGINT)")
    order_num = "CAST(sum(trans_finish_order_count) AS BIGINT) AS trans_finish_order_count"
    q["ads_line_stats"] = f"{report}, line_id, line_name, {trips}, {order_num} FROM snd GROUP BY ALL"
    q["ads_order_cargo_type_stats"] = f"""WITH {ORDER_1D} SELECT '2001-07-01' AS dt, * FROM ({nd(
        "order_1d", "cargo_type, cargo_type_name,", COUNT + ", " + AMOUNT, "1, 7, 30")})"""
    q["ads_order_stats"] = f"WITH {ORDER_1D} SELECT '2001-07-01' AS dt, * FROM ({nd('order_1d', '', COUNT + ', ' + AMOUNT, '1, 7, 30')})"
    q["ads_shift_stats"] = f"""{report}, shift_id, trans_finish_count, trans_finish_distance, trans_finish_dur_sec,
  trans_finish_order_count FROM snd"""
    q["ads_trans_order_stats"] = f"""WITH {PLACED}, {WAY}, {RECEIVE}, {DISPATCH},
  r AS ({nd("rec", "", COUNT + ", " + AMOUNT, "1, 7, 30")}), d AS ({nd("dsp", "", COUNT + ", " + AMOUNT, "1, 7, 30")})
SELECT '2001-07-01' AS dt, coalesce(r.recent_days, d.recent_days) AS recent_days, r.order_count AS receive_order_count,
  r.order_amount AS receive_order_amount, d.order_count AS dispatch_order_count, d.order_amount AS dispatch_order_amount
FROM r FULL JOIN d ON r.recent_days = d.recent_days"""
    q["ads_trans_order_stats_td"] = f"""WITH {WAY}, a AS (SELECT count(*) AS n, sum(amount) AS s FROM {once("dispatch")} WHERE dt <= {ORDER_DAY}),
  b AS (SELECT count(*) AS n, sum(amount) AS s FROM {once("bound_finish")} WHERE dt <= {ORDER_DAY})
SELECT '2001-07-01' AS dt, a.n - b.n AS bounding_order_count, CAST(a.s - b.s AS DOUBLE) AS bounding_order_amount FROM a, b"""
    q["ads_trans_stats"] = f"""WITH {TRIPS} SELECT '2001-07-01' AS dt, * FROM ({nd(
        "trip", "", "count(*) AS trans_finish_count, sum(actual_distance) AS trans_finish_distance, CAST(sum(finish_dur_sec) AS BIGINT) AS trans_finish_dur_sec",
        "1, 7, 30")})"""
    q["ads_truck_stats"] = f"""WITH {PLACED}, {SHIFT_ND}, g AS (SELECT recent_days, truck_model_type, truck_model_type_name, {TRIP} FROM snd GROUP BY ALL)
SELECT '2001-07-01' AS dt, recent_days, truck_model_type, truck_model_type_name, {TRIP_OUT}, {MEANS} FROM g"""
    return {f"logistics_{k}": v for k, v in q.items()}
