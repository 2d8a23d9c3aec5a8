"""Operator queries."""

from __future__ import annotations

from oracles.retail import EV, PHONE, TIME, phone

ORDER_TABLES = "['order_info','order_detail','payment_info','order_refund','cart_info','favor_info','comment_info','user_log']"
ODS_TABLES = "['ods_user_info','ods_order_info','ods_order_detail','ods_pay_detail','ods_refund_info','ods_other']"

CHG = f"""chg AS (
  SELECT o_orderkey AS key, list_extract({ORDER_TABLES}, CAST(o_orderkey % 8 + 1 AS INTEGER)) AS tab,
         list_extract(['c','u','d','r'], CAST(o_orderkey // 8 % 4 + 1 AS INTEGER)) AS op,
         epoch_ms(o_orderdate) + o_orderkey % 86400000 AS ts_ms, o_custkey, o_orderstatus, o_totalprice,
         o_orderkey % 50 = 0 AS broken
  FROM orders)"""
ODS = f"""ods AS (
  SELECT o_orderkey AS key, list_extract({ODS_TABLES}, CAST(o_orderkey % 6 + 1 AS INTEGER)) AS tab,
         list_extract(['c','u','d','r'], CAST(o_orderkey // 6 % 4 + 1 AS INTEGER)) AS op, epoch_ms(o_orderdate) AS ts_ms,
         CAST(o_orderdate AS DATE) AS dt
  FROM orders)"""

ROUTED = f"""WITH {CHG}, r AS (SELECT key AS id, CASE op WHEN 'r' THEN 'c' ELSE op END AS op, ts_ms AS event_time,
  CASE tab WHEN 'order_info' THEN 'order_info' WHEN 'order_detail' THEN 'order_detail' WHEN 'payment_info' THEN 'payment_info'
    WHEN 'order_refund' THEN 'refund_info' WHEN 'comment_info' THEN 'comment_info'
    WHEN 'cart_info' THEN CASE WHEN op IN ('c', 'r') THEN 'cart_add' END
    WHEN 'favor_info' THEN CASE WHEN op IN ('c', 'r') THEN 'favor_add' END END AS stream FROM chg WHERE NOT broken)
SELECT * FROM r WHERE stream IS NOT NULL"""

DWD_TOPIC = """CASE WHEN tab IN ('ods_user_info','ods_order_info','ods_order_detail','ods_pay_detail','ods_refund_info')
  THEN 'dwd_' || substr(tab, 5) ELSE 'dwd_behavior_log' END"""

CUSTOMER_DIM = """SELECT 'dim_customer' AS sink_table, md5(CAST(c_custkey AS VARCHAR)) AS row_key,
  'c_custkey=' || c_custkey || ',c_mktsegment=' || c_mktsegment || ',c_name=' || c_name || ',c_nationkey=' || c_nationkey AS columns,
  c_custkey AS ts_ms FROM customer WHERE c_custkey % 10 <> 0"""

GOOD = """good AS (
  SELECT *, epoch_us(ts) // 1000 AS ms, CASE WHEN user_id % 3 = 2 THEN 'u' || user_id ELSE 'm' || user_id END AS visitor,
         user_id || '-' || dt AS sid, CAST(floor(value * 1000) AS BIGINT) AS during_time
  FROM ev WHERE k % 50 <> 0)"""
SHOWN = "shown AS (SELECT ms AS ts, visitor, CAST(k AS VARCHAR) AS sku_id FROM good WHERE event_type = 'view')"
ACTED = """acted AS (SELECT ms AS ts, visitor, CAST(k AS VARCHAR) AS sku_id,
  list_extract(['click', 'favor', 'cart'], CAST(k % 4 + 1 AS INTEGER)) AS metric
  FROM good WHERE event_type = 'click' AND k % 4 < 3)"""


def java_hash(text: str) -> str:
    return (f"(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
            f"lambda a, c: (a * 31 + c) % 4294967296) & 2147483647) % 16")


def salted(prefix: str, text: str) -> str:
    return f"'{prefix}_' || {text} || '_' || lpad(CAST({java_hash(text)} AS VARCHAR), 2, '0')"


def hex3(text: str) -> str:
    digit = "(strpos('0123456789abcdef', substr(md5({0}), {1}, 1)) - 1)"
    return f"({digit.format(text, 30)} * 256 + {digit.format(text, 31)} * 16 + {digit.format(text, 32)})"


def sql() -> dict[str, str]:
    q = {}
    q["cdc_normalize"] = f"""WITH {CHG} SELECT key AS id, o_custkey AS user_id, o_orderstatus AS status, o_totalprice AS total_amount,
  tab AS _table, CASE op WHEN 'r' THEN 'c' ELSE op END AS op, ts_ms AS event_time FROM chg WHERE NOT broken"""
    q["cdc_route"] = ROUTED
    q["cdc_after"] = f"""WITH {ODS} SELECT op AS __op, tab AS __table, CASE WHEN tab <> 'ods_other' THEN CAST(key AS VARCHAR) END AS __pk,
  ts_ms, CAST(dt AS VARCHAR) AS dt,
  'order_detail_id=' || key || ',order_id=' || key || ',pay_id=' || key || ',refund_id=' || key || ',user_id=' || key AS "after"
FROM ods WHERE op <> 'd'"""
    q["topic_route"] = f"""WITH {CHG}, {ODS}, x AS (
  SELECT 'ods_mysql_' || tab || '_raw' AS topic FROM ods
  UNION ALL SELECT 'ods_mysql_' || CASE WHEN broken THEN 'unknown' ELSE tab END || '_raw' FROM chg
  UNION ALL SELECT 'ods_mysql_' || tab FROM ods WHERE op <> 'd'
  UNION ALL SELECT {DWD_TOPIC} FROM ods WHERE op <> 'd')
SELECT topic, count(*) AS n FROM x GROUP BY 1"""
    q["config_clean"] = """SELECT list_extract(['c','u','d','r'], CAST(s_suppkey % 4 + 1 AS INTEGER)) AS op,
  CASE WHEN s_suppkey % 4 = 2 THEN 'dim_' || s_suppkey END AS before_table,
  CASE WHEN s_suppkey % 4 <> 2 THEN 'dim_' || s_suppkey END AS after_table, s_suppkey AS ts_ms FROM supplier"""
    q["snapshot_phase"] = f"""WITH {ODS} SELECT tab AS "table", CASE op WHEN 'r' THEN 'snapshot' ELSE 'stream' END AS phase,
  count(*) AS n FROM ods GROUP BY ALL"""
    q["dim_route"] = CUSTOMER_DIM
    q["device_load"] = f"""WITH {EV} SELECT CAST(event_id AS VARCHAR) AS log_id, 'brand' || (k % 3) AS brand, 'u' || user_id AS uname,
  '10.0.0.' || (k % 200) AS ip, 'wifi' AS net, event_type AS opa, value AS ts, 'p' || k AS product_id,
  'w' || (k % 5) || ',w' || (k % 7) AS keywords FROM ev WHERE k % 50 <> 0"""
    q["json_lines"] = f"""WITH {EV} SELECT CASE WHEN k % 50 <> 0 THEN CAST(event_id AS VARCHAR) END AS log_id,
  CASE WHEN k % 50 <> 0 THEN event_type END AS opa, CASE WHEN k % 50 <> 0 THEN value END AS ts,
  CASE WHEN k % 50 = 0 THEN 'broken' END AS broken FROM ev"""
    q["user_dim_salted"] = f"""WITH {ODS}, u AS (SELECT CAST(key AS VARCHAR) AS user_id, ts_ms FROM ods
  WHERE tab = 'ods_user_info' AND op IN ('c', 'u'))
SELECT {salted("dim_user_info", "user_id")} AS row_key, user_id, ts_ms FROM u"""
    q["dirty_split"] = f"""WITH {EV} SELECT CASE WHEN k % 50 = 0 THEN 'dirty' ELSE 'ok' END AS kind, count(*) AS n FROM ev GROUP BY 1"""
    q["log_split"] = f"""WITH {EV}, {GOOD}, x AS (
  SELECT 'err' AS kind, dt FROM good WHERE event_type = 'error'
  UNION ALL SELECT 'start', dt FROM good WHERE event_type = 'signup'
  UNION ALL SELECT 'display', dt FROM good, (SELECT unnest([1, 2])) WHERE event_type = 'view'
  UNION ALL SELECT 'action', dt FROM good WHERE event_type = 'click'
  UNION ALL SELECT 'page', dt FROM good WHERE event_type <> 'signup')
SELECT kind, strftime(dt, '%Y%m%d') AS ds, count(*) AS n FROM x GROUP BY ALL"""
    q["display_normalize"] = f"WITH {EV}, {GOOD}, {SHOWN} SELECT * FROM shown"
    q["action_normalize"] = f"WITH {EV}, {GOOD}, {ACTED} SELECT * FROM acted"
    q["is_new_fixed"] = f"""WITH {EV} SELECT event_id, 'm' || user_id AS mid, epoch_us(ts) // 1000 AS ts,
  CASE WHEN dt = min(dt) OVER (PARTITION BY user_id) THEN '1' ELSE '0' END AS is_new FROM ev"""
    q["sensitive_flag"] = r"""WITH w AS (
  SELECT DISTINCT split_part(regexp_replace(text, '\s+', ',', 'g'), ',', -1) AS word FROM benchmark),
d AS (SELECT doc_id, split_part(regexp_replace(regexp_replace(text, '\s+', ',', 'g'), ',+$', ''), ',', -1) AS word FROM documents)
SELECT doc_id, CASE WHEN w.word IS NOT NULL THEN 1 ELSE 0 END AS is_violation,
  CASE WHEN w.word IS NOT NULL THEN 'P0' ELSE '' END AS violation_grade, coalesce(w.word, '') AS violation_msg
FROM d LEFT JOIN (SELECT word FROM w WHERE word <> '') w ON d.word = w.word"""
    text = "CAST(c_custkey AS VARCHAR)"
    q["hash_bucket"] = f"""SELECT c_custkey, CASE c_custkey WHEN 7 THEN '9001' WHEN 11 THEN '9002'
  ELSE lpad(CAST({hex3(text)} % 128 AS VARCHAR), 4, '0') END AS bucket, {salted("user", text)} AS row_key FROM customer"""
    q["masking_suite"] = f"""WITH c AS (SELECT *, {phone("c_custkey")} AS p FROM customer), d AS (
  SELECT *, regexp_matches(p, '{PHONE}') AS fine FROM c)
SELECT c_custkey, substr(c_name, 1, 1) || '*' AS name, CASE WHEN fine THEN substr(p, 1, 3) || '*' END AS short_phone,
  CASE WHEN fine THEN substr(p, 1, 3) || '****' || substr(p, 8, 4) END AS middle_phone, CASE WHEN fine THEN md5(p) END AS hashed_phone,
  '***@x.org' AS email FROM d"""
    q["scalar_suite"] = f"""WITH {EV} SELECT event_id, strftime(ts, '%Y%m%d') AS "day", strftime(ts, {TIME}) AS "at",
  CAST(dt AS VARCHAR) AS "date", CAST(floor(k * 700 / 1000) AS BIGINT) AS seconds, strftime(ts, {TIME}) AS iso,
  coalesce(nullif(k % 3, 0), nullif(k % 2, 0), 9) AS picked, CASE WHEN k % 2 = 0 THEN 'm1' ELSE 'u1' END AS visitor,
  CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS blank, 'step-' || k || ':' || event_type AS step, event_type AS "last",
  CAST(round(k / nullif(k % 4, 0), 2) AS DOUBLE) AS part FROM ev"""
    q["day_partitions"] = """WITH b AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders),
  d AS (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY)) AS d FROM b)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "day", count(o_orderkey) AS orders
FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1"""
    q["session_steps"] = """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events"""
    q["report_history"] = f"WITH {EV} SELECT CAST(dt AS VARCHAR) AS dt, event_type, count(*) AS n FROM ev GROUP BY ALL"
    q["ingest_full_inc"] = f"""WITH {EV} SELECT 'full' AS load, '2001-07-01' AS dt, count(*) AS n FROM customer
UNION ALL SELECT 'inc', CAST(dt AS VARCHAR), count(*) FROM ev GROUP BY ALL"""
    q["append_days"] = f"""WITH {EV} SELECT CAST(dt AS VARCHAR) AS dt,
  count(*) * CASE WHEN dt = DATE '2024-01-30' THEN 2 ELSE 1 END AS n FROM ev GROUP BY ev.dt"""
    q["day_bucket"] = f"""WITH {EV} SELECT CASE WHEN k % 10 = 0 THEN 'error_bucket' ELSE strftime(dt, '%Y%m%d') END AS "day",
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM ev GROUP BY 1"""
    q["topic_files"] = """SELECT 'log_' || event_type AS topic, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1"""
    q["snapshot_upsert"] = """WITH o AS (SELECT o_custkey, max(o_orderkey) AS v, max_by(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1)
SELECT c_custkey AS id, CASE WHEN v IS NULL THEN c_name END AS name, coalesce(p, c_mktsegment) AS level, coalesce(v, 0) AS version
FROM customer LEFT JOIN o ON c_custkey = o_custkey"""
    q["snapshot_merge_columns"] = """WITH o AS (SELECT o_custkey, max(o_orderkey) AS v,
  max_by(o_orderpriority, o_orderkey) FILTER (o_orderkey % 2 = 0) AS p FROM orders GROUP BY 1)
SELECT c_custkey AS id, c_name AS name, coalesce(p, c_mktsegment) AS level, coalesce(v, 0) AS version
FROM customer LEFT JOIN o ON c_custkey = o_custkey"""
    return q
