"""Retail queries."""

from __future__ import annotations

ORDER_DAY = "DATE '2001-07-01'"
EVENT_DAY = "DATE '2024-01-30'"

EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(ts AS DATE) AS dt
  FROM events)"""

SKU = """sku AS (
  SELECT p_partkey AS id, p_name AS sku_name, CAST(p_size AS BIGINT) AS category3_id, 'c3-' || p_size AS category3_name,
         CAST(p_size % 10 AS BIGINT) AS category2_id, 'c2-' || (p_size % 10) AS category2_name,
         CAST(p_size % 10 % 3 AS BIGINT) AS category1_id, 'c1-' || (p_size % 10 % 3) AS category1_name,
         CAST(substr(p_brand, 7) AS BIGINT) AS tm_id, p_brand AS tm_name
  FROM part)"""
SKU_COLS = """sku.sku_name, sku.category1_id, sku.category1_name, sku.category2_id, sku.category2_name,
  sku.category3_id, sku.category3_name, sku.tm_id, sku.tm_name"""
SKU_OUT = SKU_COLS.replace("sku.", "")

ACT = """act AS (
  SELECT l_orderkey * 10 + l_linenumber AS did, CAST(round(max(l_discount) * 100) AS BIGINT) AS activity_id
  FROM lineitem WHERE l_discount >= 0.05 GROUP BY 1),
cou AS (
  SELECT l_orderkey * 10 + l_linenumber AS did, 3200 + CAST(round(max(l_tax) * 100) AS BIGINT) AS coupon_id
  FROM lineitem WHERE l_tax >= 0.04 GROUP BY 1)"""

LINES = """li AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(l_shipdate AS DATE) AS dt, l_shipdate, CAST(l_quantity AS BIGINT) AS sku_num,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total,
         CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,2)) AS original,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS activity,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS coupon
  FROM lineitem),
od AS (
  SELECT li.*, o_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS province_id
  FROM li LEFT JOIN orders ON order_id = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""

PAY = """pay AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, '110' || substr(o_orderpriority, 1, 1) AS payment_type,
         o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) + to_seconds(o_orderkey % 3600) AS callback_time,
         CAST(o_totalprice AS DECIMAL(18,2)) AS payment_amount
  FROM orders WHERE o_orderstatus = 'F')"""

PV = """pv AS (
  SELECT user_id || '-' || dt AS session_id, 'm' || user_id AS mid_id, 'b' || (user_id % 5) AS brand,
         'md' || (user_id % 7) AS model, 'os' || (user_id % 2) AS operate_system, 'v' || (user_id % 3) AS version_code,
         'ch' || (user_id % 4) AS channel,
         list_extract(['home','good_detail','cart','order','payment','mine'], CAST(k % 6 + 1 AS INTEGER)) AS page_id,
         CAST(floor(value * 1000) AS BIGINT) AS during_time, ts AS view_time, event_id AS view_id, dt
  FROM ev WHERE event_type <> 'error')"""

PROVINCE = """pr AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS province_name, CAST(n_nationkey + 100 AS VARCHAR) AS area_code,
         'ISO-' || n_nationkey AS iso_code, 'XX-' || n_nationkey AS iso_3166_2, CAST(n_regionkey AS BIGINT) AS region_id
  FROM nation)"""
PROV = "province_name, area_code, iso_code, iso_3166_2"


def dic(parent: str, word: str) -> str:
    return (f"(SELECT '{parent}0' || (r_regionkey + 1) AS code, '{word} ' || r_name AS dic_name FROM region)")


PHONE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def phone(key: str) -> str:
    return (f"CASE WHEN {key} % 7 = 0 THEN '999' WHEN {key} % 11 <> 0 "
            f"THEN '138' || lpad(CAST({key} % 100000000 AS VARCHAR), 8, '0') END")


def customer_email() -> str:
    return ("CASE WHEN c_custkey % 5 = 0 THEN 'bad-address' "
            "ELSE lower(c_mktsegment) || c_custkey || '@mail.example.com' END")


USK = f"""{LINES}, {SKU}, usk0 AS (
  SELECT dt, user_id, sku_id, count(*) AS order_count_1d, CAST(sum(sku_num) AS BIGINT) AS order_num_1d,
         sum(original) AS original_1d, sum(activity) AS activity_1d, sum(coupon) AS coupon_1d, sum(total) AS total_1d
  FROM od GROUP BY ALL),
usk AS (SELECT usk0.*, {SKU_COLS} FROM usk0 LEFT JOIN sku ON usk0.sku_id = sku.id)"""

SUMS = """CAST(original_1d AS DOUBLE) AS order_original_amount_1d, CAST(activity_1d AS DOUBLE) AS activity_reduce_amount_1d,
  CAST(coupon_1d AS DOUBLE) AS coupon_reduce_amount_1d, CAST(total_1d AS DOUBLE) AS order_total_amount_1d"""

UO = f"""{LINES}, uo AS (
  SELECT dt, user_id, count(DISTINCT order_id) AS order_count_1d, CAST(sum(sku_num) AS BIGINT) AS order_num_1d,
         sum(original) AS original_1d, sum(activity) AS activity_1d, sum(coupon) AS coupon_1d, sum(total) AS total_1d
  FROM od GROUP BY ALL)"""

PO = f"""{LINES}, {PROVINCE}, po AS (
  SELECT dt, province_id, {PROV}, count(DISTINCT order_id) AS order_count_1d, sum(original) AS original_1d,
         sum(activity) AS activity_1d, sum(coupon) AS coupon_1d, sum(total) AS total_1d
  FROM od LEFT JOIN pr ON province_id = pr.id GROUP BY ALL)"""

PAYLINES = f"""{LINES}, {PAY}, {ACT}, pl AS (
  SELECT li.*, pay.user_id, payment_type, callback_time, CAST(callback_time AS DATE) AS pay_dt,
         CAST(c_nationkey AS BIGINT) AS province_id
  FROM li JOIN pay USING (order_id) LEFT JOIN orders ON order_id = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""

LOGIN = f"""{EV}, login AS (
  SELECT user_id, min(dt) AS login_date_first, max(dt) AS login_date_last, count(*) AS login_count_td
  FROM ev WHERE event_type = 'view' AND dt <= {EVENT_DAY} GROUP BY 1)"""


def _days(days, base, dt="dt"):
    return f"{dt} BETWEEN {base} - {days - 1} AND {base}"


def _nd(cols: dict[str, str], base: str, kind="DOUBLE"):
    parts = []
    for n in (7, 30):
        for out, src in cols.items():
            t = "BIGINT" if out in ("order_count", "order_num") else kind
            parts.append(f"CAST(sum(CASE WHEN {_days(n, base)} THEN {src} ELSE 0 END) AS {t}) AS {out}_{n}d")
    return ", ".join(parts)


ND = {"order_count": "order_count_1d", "order_num": "order_num_1d", "order_original_amount": "original_1d",
      "activity_reduce_amount": "activity_1d", "coupon_reduce_amount": "coupon_1d", "order_total_amount": "total_1d"}


def orders_by(keys: str) -> str:
    return f"""WITH {USK}, d AS (SELECT unnest([1, 7, 30]) AS recent_days)
SELECT '2001-07-01' AS dt, recent_days, {keys}, CAST(sum(order_count_1d) AS BIGINT) AS order_count,
       count(DISTINCT user_id) AS order_user_count
FROM usk, d WHERE dt BETWEEN {ORDER_DAY} - recent_days + 1 AND {ORDER_DAY} GROUP BY ALL"""


def rule(code: str, family: str) -> str:
    third = "'减' || benefit_amount || '元'" if family == "32" else "'打' || benefit_discount || '折'"
    return f"""CASE {code} WHEN '{family}01' THEN '满' || condition_amount || '元减' || benefit_amount || '元'
      WHEN '{family}02' THEN '满' || condition_num || '件打' || benefit_discount || ' 折'
      WHEN '{family}03' THEN {third} END"""


COUPON = f"""cp AS (
  SELECT id, 'coupon ' || id AS coupon_name, '320' || (id % 3 + 1) AS coupon_type_code, id % 7 * 100 AS condition_amount,
         id % 4 + 1 AS condition_num, id % 5 AS activity_id, id % 9 * 5 AS benefit_amount,
         id % 9 + 1 AS benefit_discount, '330' || (id % 3 + 1) AS range_type_code, id % 10 AS limit_num,
         id % 6 AS taken_count
  FROM (SELECT DISTINCT 3200 + CAST(round(l_tax * 100) AS BIGINT) AS id FROM lineitem)),
cpn AS (
  SELECT cp.*, c.dic_name AS coupon_type_name, r.dic_name AS range_type_name, {rule("coupon_type_code", "32")} AS benefit_rule
  FROM cp LEFT JOIN {dic("32", "coupon")} c ON coupon_type_code = c.code
  LEFT JOIN {dic("33", "range")} r ON range_type_code = r.code)"""


def users_init() -> str:
    return f"""SELECT c_custkey AS id, substr(c_name, 1, 1) || '*' AS name,
    CASE WHEN regexp_matches({phone("c_custkey")}, '{PHONE}') THEN substr({phone("c_custkey")}, 1, 3) || '*' END AS phone_num,
    CASE WHEN regexp_matches({customer_email()}, '{EMAIL}') THEN '*@' || split_part({customer_email()}, '@', 2) END AS email,
    c_mktsegment AS user_level, CAST(DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS VARCHAR) AS birthday,
    CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, '1994-01-01' AS create_time,
    '1994-01-01 00:00:00' AS operate_time FROM customer"""


def user_history(until: str = "DATE '9999-12-31'") -> str:
    changed = "o_orderdate + to_seconds(o_orderkey % 86400)"
    return f"""WITH init AS ({users_init()}), ch AS (
  SELECT o_custkey AS id, 'U*' AS name,
    CASE WHEN regexp_matches({phone("o_custkey")}, '{PHONE}')
         THEN substr({phone("o_custkey")}, 1, 3) || '****' || substr({phone("o_custkey")}, 8, 4) END AS phone_num,
    '***@new.example.com' AS email, o_orderpriority AS user_level,
    CAST(DATE '1970-01-01' + CAST(o_custkey % 10000 AS INTEGER) AS VARCHAR) AS birthday,
    CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, '1994-01-01' AS create_time,
    strftime({changed}, '%Y-%m-%d %H:%M:%S') AS operate_time, CAST(o_orderdate AS DATE) AS start_date,
    row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY {changed} DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate < {until} + INTERVAL 1 DAY),
  v AS (
  SELECT * EXCLUDE (rn) FROM ch WHERE rn = 1
  UNION ALL
  SELECT init.*, DATE '1995-01-01' FROM init
  WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.id = init.id AND ch.start_date = DATE '1995-01-01'))
SELECT id, name, phone_num, email, user_level, birthday, gender, create_time, operate_time,
       CAST(start_date AS VARCHAR) AS start_date,
       CAST(coalesce(lead(start_date) OVER (PARTITION BY id ORDER BY start_date) - 1, DATE '9999-12-31') AS VARCHAR) AS end_date
FROM v"""


TIME = "'%Y-%m-%d %H:%M:%S'"


def sql() -> dict[str, str]:
    q = {}
    q["dim_sku_full"] = f"""WITH {SKU}, sa AS (
  SELECT sku_id, string_agg(v, ',' ORDER BY v) AS sale_attrs FROM (
    SELECT DISTINCT l_partkey AS sku_id, '1:' || l_returnflag || ':flag:' || l_linestatus AS v FROM lineitem) GROUP BY 1)
SELECT p_partkey AS id, p_retailprice AS price, p_name AS sku_name, 'about ' || p_name AS sku_desc, p_size AS weight,
  p_size % 2 AS is_sale, p_partkey % 100 AS spu_id, 'spu-' || (p_partkey % 100) AS spu_name,
  category3_id, category3_name, category2_id, category2_name, category1_id, category1_name, tm_id, tm_name,
  '1:' || p_size || ':size:' || p_size || ',2:' || (p_size % 10) || ':type:' || p_type AS attrs,
  coalesce(sale_attrs, NULL) AS sale_attrs, '2000-01-01' AS create_time
FROM part JOIN sku ON p_partkey = sku.id LEFT JOIN sa ON p_partkey = sku_id"""
    q["dim_coupon_full"] = f"""WITH {COUPON}
SELECT id, coupon_name, coupon_type_code, coupon_type_name, condition_amount, condition_num, activity_id, benefit_amount,
  benefit_discount, benefit_rule, '2000-01-01' AS create_time, range_type_code, range_type_name, limit_num, taken_count,
  '2000-01-01' AS start_time, '2030-01-01' AS end_time, '2000-01-02' AS operate_time, '2031-01-01' AS expire_time FROM cpn"""
    q["dim_activity_full"] = f"""WITH a AS (
  SELECT id * 10 + 1 AS activity_rule_id, id AS activity_id, 'activity ' || id AS activity_name,
    '310' || (id % 3 + 1) AS activity_type_code, 'about ' || id AS activity_desc, '2000-01-01' AS start_time,
    '2030-01-01' AS end_time, '1999-12-01' AS create_time, id * 100 AS condition_amount, id % 4 + 1 AS condition_num,
    id * 7 AS benefit_amount, id % 9 + 1 AS benefit_discount, id % 3 AS benefit_level
  FROM (SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) AS id FROM lineitem))
SELECT a.*, dic_name AS activity_type_name, {rule("activity_type_code", "31")} AS benefit_rule
FROM a LEFT JOIN {dic("31", "activity")} d ON activity_type_code = d.code"""
    q["dim_province_full"] = f"""WITH {PROVINCE} SELECT pr.*, r_name AS region_name FROM pr
LEFT JOIN region ON region_id = r_regionkey"""
    q["dim_user_zip_init"] = f"SELECT *, '1995-01-01' AS start_date, '9999-12-31' AS end_date FROM ({users_init()})"
    q["dim_user_zip"] = user_history()
    q["dwd_trade_cart_add_inc"] = f"""WITH {EV} SELECT event_id AS id, user_id, k AS sku_id, CAST(dt AS VARCHAR) AS date_id,
  strftime(ts, {TIME}) AS create_time, k % 5 + 1 AS sku_num, CAST(dt AS VARCHAR) AS dt FROM ev WHERE event_type = 'click'"""
    q["dwd_trade_order_detail_inc"] = f"""WITH {LINES}, {ACT}
SELECT id, order_id, user_id, sku_id, province_id, activity_id, activity_id * 10 + 1 AS activity_rule_id, coupon_id,
  CAST(dt AS VARCHAR) AS date_id, strftime(l_shipdate, {TIME}) AS create_time, sku_num,
  CAST(original AS DOUBLE) AS split_original_amount, CAST(activity AS DOUBLE) AS split_activity_amount,
  CAST(coupon AS DOUBLE) AS split_coupon_amount, CAST(total AS DOUBLE) AS split_total_amount, CAST(dt AS VARCHAR) AS dt
FROM od LEFT JOIN act ON id = act.did LEFT JOIN cou ON id = cou.did"""
    q["dwd_trade_pay_detail_suc_inc"] = f"""WITH {PAYLINES}
SELECT id, order_id, user_id, sku_id, province_id, activity_id, activity_id * 10 + 1 AS activity_rule_id, coupon_id,
  payment_type, dic_name AS payment_type_name, CAST(pay_dt AS VARCHAR) AS date_id, strftime(callback_time, {TIME}) AS callback_time,
  sku_num, CAST(original AS DOUBLE) AS split_original_amount, CAST(activity AS DOUBLE) AS split_activity_amount,
  CAST(coupon AS DOUBLE) AS split_coupon_amount, CAST(total AS DOUBLE) AS split_payment_amount, CAST(pay_dt AS VARCHAR) AS dt
FROM pl LEFT JOIN act ON id = act.did LEFT JOIN cou ON id = cou.did LEFT JOIN {dic("11", "pay")} d ON payment_type = d.code"""
    q["dwd_trade_cart_full"] = f"""WITH {EV} SELECT event_id AS id, user_id, k AS sku_id, 'sku ' || k AS sku_name,
  k % 5 + 1 AS sku_num, CAST(dt AS VARCHAR) AS dt FROM ev WHERE event_type = 'click' AND value <= 10"""
    q["dwd_trade_trade_flow_acc"] = f"""WITH {PAY}
SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS province_id,
  strftime(o_orderdate, '%Y-%m-%d') AS order_date_id, strftime(o_orderdate, {TIME}) AS order_time,
  strftime(callback_time, '%Y-%m-%d') AS payment_date_id, strftime(callback_time, {TIME}) AS payment_time,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 5 DAY, '%Y-%m-%d') END AS finish_date_id,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 5 DAY, {TIME}) END AS finish_time,
  o_totalprice AS original_total_amount, CAST(o_orderkey % 5 AS DOUBLE) AS activity_reduce_amount,
  CAST(o_orderkey % 3 AS DOUBLE) AS coupon_reduce_amount, o_totalprice AS total_amount,
  CAST(coalesce(payment_amount, 0) AS DOUBLE) AS payment_amount, strftime(o_orderdate, '%Y-%m-%d') AS dt
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN pay ON o_orderkey = order_id"""
    q["dwd_tool_coupon_used_inc"] = f"""WITH {EV} SELECT event_id AS id, k % 9 + 3200 AS coupon_id, user_id, event_id AS order_id,
  CAST(dt AS VARCHAR) AS date_id, strftime(ts + INTERVAL 60 SECOND, {TIME}) AS payment_time, CAST(dt AS VARCHAR) AS dt
FROM ev WHERE event_type = 'purchase'"""
    q["dwd_interaction_favor_add_inc"] = f"""WITH {EV} SELECT event_id AS id, user_id, k AS sku_id, CAST(dt AS VARCHAR) AS date_id,
  strftime(ts, {TIME}) AS create_time, CAST(dt AS VARCHAR) AS dt FROM ev WHERE event_type = 'signup'"""

    usk_out = f"""SELECT CAST(dt AS VARCHAR) AS dt, user_id, sku_id, order_count_1d, order_num_1d, {SUMS}, {SKU_OUT} FROM usk"""
    q["dws_trade_user_sku_order_1d"] = f"WITH {USK} {usk_out}"
    q["dws_trade_user_sku_order_1d_daily"] = f"WITH {USK} {usk_out} WHERE dt = {ORDER_DAY}"
    q["dws_trade_user_order_1d"] = f"""WITH {UO} SELECT CAST(dt AS VARCHAR) AS dt, user_id, order_count_1d, order_num_1d, {SUMS} FROM uo"""
    q["dws_trade_user_cart_add_1d"] = f"""WITH {EV} SELECT CAST(dt AS VARCHAR) AS dt, user_id, count(*) AS cart_add_count_1d,
  CAST(sum(k % 5 + 1) AS BIGINT) AS cart_add_num_1d FROM ev WHERE event_type = 'click' GROUP BY ALL"""
    q["dws_trade_user_payment_1d"] = f"""WITH {PAYLINES} SELECT CAST(pay_dt AS VARCHAR) AS dt, user_id,
  count(DISTINCT order_id) AS payment_count_1d, CAST(sum(sku_num) AS BIGINT) AS payment_num_1d,
  CAST(sum(total) AS DOUBLE) AS payment_amount_1d FROM pl GROUP BY ALL"""
    q["dws_trade_province_order_1d"] = f"""WITH {PO} SELECT CAST(dt AS VARCHAR) AS dt, province_id, {PROV}, order_count_1d, {SUMS} FROM po"""
    q["dws_tool_user_coupon_coupon_used_1d"] = f"""WITH {EV}, {COUPON}, u AS (
  SELECT dt, user_id, k % 9 + 3200 AS coupon_id, count(*) AS used_count_1d FROM ev WHERE event_type = 'purchase' GROUP BY ALL)
SELECT CAST(dt AS VARCHAR) AS dt, user_id, coupon_id, used_count_1d, coupon_name, coupon_type_code, coupon_type_name, benefit_rule
FROM u LEFT JOIN cpn ON coupon_id = cpn.id"""
    fav = f"""{EV}, {SKU}, f AS (SELECT dt, k AS sku_id, count(*) AS favor_add_count_1d FROM ev WHERE event_type = 'signup' GROUP BY ALL)"""
    q["dws_interaction_sku_favor_add_1d"] = f"""WITH {fav} SELECT CAST(dt AS VARCHAR) AS dt, sku_id, favor_add_count_1d, {SKU_OUT}
FROM f LEFT JOIN sku ON sku_id = sku.id"""
    q["dws_traffic_session_page_view_1d"] = f"""WITH {EV}, {PV} SELECT CAST(dt AS VARCHAR) AS dt, session_id, mid_id, brand, model,
  operate_system, version_code, channel, CAST(sum(during_time) AS BIGINT) AS during_time_1d, count(*) AS page_count_1d
FROM pv GROUP BY ALL"""
    q["dws_traffic_page_visitor_page_view_1d"] = f"""WITH {EV}, {PV} SELECT CAST(dt AS VARCHAR) AS dt, mid_id, brand, model,
  operate_system, page_id, CAST(sum(during_time) AS BIGINT) AS during_time_1d, count(*) AS view_count_1d FROM pv GROUP BY ALL"""
    q["dws_trade_user_sku_order_nd"] = f"""WITH {USK} SELECT user_id, sku_id, {SKU_OUT}, {_nd(ND, ORDER_DAY)}
FROM usk WHERE {_days(30, ORDER_DAY)} GROUP BY ALL"""
    po_nd = {k: v for k, v in ND.items() if k != "order_num"}
    q["dws_trade_province_order_nd"] = f"""WITH {PO} SELECT province_id, {PROV}, {_nd(po_nd, ORDER_DAY)}
FROM po WHERE {_days(30, ORDER_DAY)} GROUP BY ALL"""
    q["dws_trade_user_order_td"] = f"""WITH {UO} SELECT user_id, CAST(min(dt) AS VARCHAR) AS order_date_first,
  CAST(max(dt) AS VARCHAR) AS order_date_last, CAST(sum(order_count_1d) AS BIGINT) AS order_count_td,
  CAST(sum(order_num_1d) AS BIGINT) AS order_num_td, CAST(sum(original_1d) AS DOUBLE) AS order_original_amount_td,
  CAST(sum(activity_1d) AS DOUBLE) AS activity_reduce_amount_td, CAST(sum(coupon_1d) AS DOUBLE) AS coupon_reduce_amount_td,
  CAST(sum(total_1d) AS DOUBLE) AS order_total_amount_td FROM uo WHERE dt <= {ORDER_DAY} GROUP BY 1"""
    q["dws_user_user_login_td"] = f"""WITH {LOGIN} SELECT user_id, CAST(login_date_first AS VARCHAR) AS login_date_first,
  CAST(login_date_last AS VARCHAR) AS login_date_last, login_count_td FROM login"""

    q["ads_traffic_stats_by_channel"] = f"""WITH {EV}, {PV}, s AS (
  SELECT dt, session_id, mid_id, channel, sum(during_time) AS d, count(*) AS n FROM pv GROUP BY ALL),
  x AS (SELECT unnest([1, 7, 30]) AS recent_days)
SELECT '2024-01-30' AS dt, recent_days, channel, count(DISTINCT mid_id) AS uv_count,
  CAST(floor(sum(d) / (count(*) * 1000)) AS BIGINT) AS avg_duration_sec, CAST(floor(sum(n) / count(*)) AS BIGINT) AS avg_page_count,
  count(*) AS sv_count, CAST(round(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / count(*), 2) AS DOUBLE) AS bounce_rate
FROM s, x WHERE dt BETWEEN {EVENT_DAY} - recent_days + 1 AND {EVENT_DAY} GROUP BY ALL"""
    q["ads_page_path"] = f"""WITH {EV}, {PV}, s AS (
  SELECT page_id, lead(page_id) OVER w AS nxt, row_number() OVER w AS rn FROM pv WHERE dt = {EVENT_DAY}
  WINDOW w AS (PARTITION BY session_id ORDER BY view_time, view_id))
SELECT '2024-01-30' AS dt, 'step-' || rn || ':' || page_id AS source, coalesce('step-' || (rn + 1) || ':' || nxt, 'null') AS target,
  count(*) AS path_count FROM s GROUP BY ALL"""
    q["ads_user_change"] = f"""WITH {LOGIN}, prev AS (
  SELECT user_id, max(dt) AS p FROM ev WHERE event_type = 'view' AND dt < {EVENT_DAY} GROUP BY 1)
SELECT '2024-01-30' AS dt, (SELECT count(*) FROM login WHERE login_date_last = {EVENT_DAY} - 7) AS user_churn_count,
  (SELECT count(*) FROM login JOIN prev USING (user_id) WHERE login_date_last = {EVENT_DAY} AND {EVENT_DAY} - p >= 8) AS user_back_count"""
    q["ads_user_stats"] = f"""WITH {LOGIN}, x AS (SELECT unnest([1, 7, 30]) AS recent_days)
SELECT '2024-01-30' AS dt, recent_days, count(*) FILTER (login_date_first >= {EVENT_DAY} - recent_days + 1) AS new_user_count,
  count(*) AS active_user_count FROM login, x WHERE login_date_last >= {EVENT_DAY} - recent_days + 1 GROUP BY ALL"""
    q["ads_user_action"] = f"""WITH {EV}, {PV}, d AS (SELECT * FROM ev WHERE dt = {EVENT_DAY})
SELECT '2024-01-30' AS dt,
  (SELECT count(DISTINCT mid_id) FROM pv WHERE dt = {EVENT_DAY} AND page_id = 'home') AS home_count,
  (SELECT count(DISTINCT mid_id) FROM pv WHERE dt = {EVENT_DAY} AND page_id = 'good_detail') AS good_detail_count,
  (SELECT count(DISTINCT user_id) FROM d WHERE event_type = 'click') AS cart_count,
  (SELECT count(DISTINCT user_id) FROM d WHERE event_type = 'purchase') AS order_count,
  (SELECT count(DISTINCT user_id) FROM d WHERE event_type = 'purchase' AND value > 20) AS payment_count"""
    q["ads_order_continuously_user_count"] = f"""WITH {LINES}, u AS (
  SELECT DISTINCT user_id, dt FROM od WHERE {_days(7, ORDER_DAY)})
SELECT '2001-07-01' AS dt, 7 AS recent_days, count(DISTINCT a.user_id) AS order_continuously_user_count
FROM u a JOIN u b ON a.user_id = b.user_id AND b.dt = a.dt + 1 JOIN u c ON a.user_id = c.user_id AND c.dt = a.dt + 2"""
    q["ads_repeat_purchase_by_tm"] = f"""WITH {USK}, u AS (
  SELECT user_id, tm_id, tm_name, sum(order_count_1d) AS n FROM usk WHERE {_days(30, ORDER_DAY)} GROUP BY ALL)
SELECT '2001-07-01' AS dt, 30 AS recent_days, tm_id, tm_name,
  CAST(round(count(*) FILTER (n >= 2) / count(*) FILTER (n >= 1), 2) AS DOUBLE) AS order_repeat_rate FROM u GROUP BY ALL"""
    q["ads_order_stats_by_tm"] = orders_by("tm_id, tm_name")
    q["ads_order_stats_by_cate"] = orders_by(
        "category1_id, category1_name, category2_id, category2_name, category3_id, category3_name")
    q["ads_sku_cart_num_top3_by_cate"] = f"""WITH {EV}, {SKU}, c AS (
  SELECT k AS sku_id, CAST(sum(k % 5 + 1) AS BIGINT) AS cart_num FROM ev
  WHERE event_type = 'click' AND value <= 10 AND dt = {EVENT_DAY} GROUP BY 1)
SELECT '2024-01-30' AS dt, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name,
  sku_id, sku_name, cart_num, CAST(rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) AS INTEGER) AS rk
FROM c LEFT JOIN sku ON sku_id = sku.id QUALIFY rk <= 3"""
    q["ads_sku_favor_count_top3_by_tm"] = f"""WITH {fav}
SELECT '2024-01-30' AS dt, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d,
  CAST(rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) AS INTEGER) AS rk
FROM f LEFT JOIN sku ON sku_id = sku.id WHERE dt = {EVENT_DAY} QUALIFY rk <= 3"""
    q["ads_order_to_pay_interval_avg"] = f"""WITH {PAY}
SELECT '2001-07-01' AS dt, CAST(floor(avg(epoch(callback_time) - epoch(o_orderdate))) AS BIGINT) AS order_to_pay_interval_avg
FROM orders JOIN pay ON o_orderkey = order_id WHERE CAST(callback_time AS DATE) = {ORDER_DAY}"""
    q["ads_order_by_province"] = f"""WITH {PO}, x AS (SELECT unnest([1, 7, 30]) AS recent_days),
  base AS (SELECT * FROM po WHERE {_days(30, ORDER_DAY)})
SELECT '2001-07-01' AS dt, recent_days, province_id, {PROV},
  CAST(sum(CASE WHEN dt >= {ORDER_DAY} - recent_days + 1 THEN order_count_1d ELSE 0 END) AS BIGINT) AS order_count,
  CAST(sum(CASE WHEN dt >= {ORDER_DAY} - recent_days + 1 THEN total_1d ELSE 0 END) AS DOUBLE) AS order_total_amount
FROM base, x GROUP BY ALL HAVING recent_days > 1 OR count(*) FILTER (dt = {ORDER_DAY}) > 0"""
    return {f"retail_{k}": v for k, v in q.items()}
