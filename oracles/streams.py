"""Streaming queries, as SQL over the whole tables."""

from __future__ import annotations

from oracles.operators import ACTED, CUSTOMER_DIM, DWD_TOPIC, GOOD, ODS, ROUTED, SHOWN, salted
from oracles.retail import EV, TIME

LINES = """line AS (
  SELECT user_id AS order_id, k AS sku_id, user_id, k % 5 + 1 AS sku_num, epoch_us(ts) // 1000 AS ms,
         CASE WHEN k % 2 = 1 THEN CAST(value AS DECIMAL(18,2)) ELSE CAST(value * (k % 5 + 1) AS DECIMAL(18,2)) END AS amount
  FROM ev WHERE event_type = 'purchase')"""

MIN = "{0} // 60000 * 60000 AS stt, {0} // 60000 * 60000 + 60000 AS edt"

ORDER_MIN = f"""{LINES}, omin AS (
  SELECT {MIN.format("ms")}, sku_id, count(*) AS order_ct, CAST(sum(sku_num) AS BIGINT) AS sku_num, sum(amount) AS order_amount,
         count(DISTINCT user_id) AS order_user_ct FROM line GROUP BY ALL)"""


def pairs(kind: str, name: str, prefix: str) -> str:
    return f"""{name} AS (
  SELECT {MIN.format("(epoch_us(b.ts) // 1000)")}, line.sku_id, count(*) AS {prefix}_ct, sum(CAST(b.value AS DECIMAL(18,2))) AS {prefix}_amount,
         count(DISTINCT b.user_id) AS {prefix}_user_ct
  FROM ev b JOIN line ON b.user_id = line.order_id AND line.ms BETWEEN (epoch_us(b.ts) // 1000) - 7200000 AND epoch_us(b.ts) // 1000 + 7200000
  WHERE b.event_type = '{kind}' GROUP BY ALL)"""


PAY = pairs("signup", "pmin", "payment")
REF = pairs("error", "rmin", "refund")

ACT_MIN = f"""{GOOD}, {SHOWN}, {ACTED}, av AS (SELECT ts, visitor, sku_id, 'exposure' AS metric FROM shown UNION ALL SELECT * FROM acted),
amin AS (
  SELECT {MIN.format("ts")}, sku_id, """ + ", ".join(
    f"count(*) FILTER (metric = '{m}') AS {m}_ct, count(DISTINCT visitor) FILTER (metric = '{m}') AS {m}_user_ct"
    for m in ("exposure", "click", "favor", "cart")) + " FROM av GROUP BY ALL)"

VISIT_MIN = f"""{GOOD}, pg AS (SELECT {MIN.format("ms")}, visitor, sid, during_time FROM good WHERE event_type <> 'signup'),
st AS (SELECT {MIN.format("ms")}, count(DISTINCT sid) AS session_ct FROM good WHERE event_type = 'signup' GROUP BY ALL),
se AS (SELECT stt, count(*) AS bounce_ct FROM (SELECT stt, sid FROM pg GROUP BY ALL HAVING count(*) = 1) GROUP BY 1),
pa AS (SELECT stt, edt, count(*) AS pv, count(DISTINCT visitor) AS uv, CAST(sum(during_time) AS BIGINT) AS duration_ms FROM pg GROUP BY ALL),
vmin AS (
  SELECT coalesce(pa.stt, st.stt) AS stt, coalesce(pa.edt, st.edt) AS edt, coalesce(pv, 0) AS pv, coalesce(uv, 0) AS uv,
         coalesce(duration_ms, 0) AS duration_ms, coalesce(bounce_ct, 0) AS bounce_ct, coalesce(session_ct, 0) AS session_ct
  FROM pa FULL JOIN st ON pa.stt = st.stt LEFT JOIN se ON pa.stt = se.stt)"""

DAY = "strftime(make_timestamp_ms(stt), '%Y-%m-%d') AS dt"


def z(expr: str, kind: str = "BIGINT") -> str:
    return f"CAST(coalesce(sum({expr}), 0) AS {kind}) AS {expr}"


ORDER_SUMS = f"{z('order_ct')}, {z('order_user_ct')}, {z('sku_num')}, {z('order_amount', 'DOUBLE')}"
PAY_SUMS = f"{z('payment_ct')}, {z('payment_user_ct')}, {z('payment_amount', 'DOUBLE')}"
REF_SUMS = f"{z('refund_ct')}, {z('refund_user_ct')}, {z('refund_amount', 'DOUBLE')}"
ALL_MIN = f"""{EV}, {ORDER_MIN}, {PAY}, {REF}, u AS (
  SELECT * FROM omin UNION ALL BY NAME SELECT * FROM pmin UNION ALL BY NAME SELECT * FROM rmin)"""

COMMENT = """cm AS (
  SELECT epoch_us(ts) // 1000 AS ts_ms, 'shop' AS db, 'comment_info' AS "table", '1' AS server_id, '120' || (k % 4 + 1) AS appraise,
         'nice,' || event_type || ',w' || (k % 10) AS "commentTxt", 'c' AS op, CAST(NULL AS VARCHAR) AS nick_name,
         epoch_us(ts) // 1000 AS create_time, user_id, k AS sku_id, event_id AS id, k % 7 AS spu_id, k % 5 + 1 AS order_id,
         strftime(ts, '%Y%m%d') AS ds, coalesce(r_name, 'N/A') AS dic_name
  FROM ev LEFT JOIN region ON r_regionkey < 3 AND r_regionkey = k % 4 WHERE event_type = 'view'),
om AS (
  SELECT k % 5 + 1 AS info_id, user_id AS info_user_id, 'C' || user_id AS info_consignee, 'u' AS info_op, epoch_us(ts) // 1000 AS info_tm_ms
  FROM ev WHERE event_type = 'purchase'),
cj AS (SELECT * FROM cm JOIN om ON order_id = info_id AND info_tm_ms BETWEEN ts_ms - 60000 AND ts_ms + 60000)"""


def sql() -> dict[str, str]:
    q = {}
    omin = "SELECT stt, edt, sku_id, order_ct, sku_num, CAST(order_amount AS DOUBLE) AS order_amount, order_user_ct FROM omin"
    q["stream_order_minute_closed"] = f"WITH {EV}, {ORDER_MIN} {omin}"
    q["stream_order_minute"] = f"WITH {EV}, {ORDER_MIN} {omin} WHERE edt <= (SELECT max(ms) - 3000 FROM line)"
    pmin = "SELECT stt, edt, sku_id, payment_ct, CAST(payment_amount AS DOUBLE) AS payment_amount, payment_user_ct FROM pmin"
    q["stream_payment_join"] = f"WITH {EV}, {LINES}, {PAY} {pmin}"
    q["stream_payment_minute"] = f"WITH {EV}, {LINES}, {PAY} {pmin}"
    q["stream_refund_join"] = f"""WITH {EV}, {LINES}, {REF} SELECT stt, edt, sku_id, refund_ct,
  CAST(refund_amount AS DOUBLE) AS refund_amount, refund_user_ct FROM rmin"""
    q["stream_refund_minute"] = q["stream_refund_join"]
    q["stream_order_late"] = f"""WITH {EV}, {LINES}, b AS (SELECT min(ms) AS low, max(ms) AS high FROM line),
f AS (SELECT sku_id, sku_num, ms, CASE WHEN sku_id % 50 <> 9 THEN ms END AS tm,
  least((ms - low) * 4 // (high - low + 1) + CASE WHEN sku_id % 20 = 3 THEN 1 ELSE 0 END, 3) AS file FROM line, b),
h AS (SELECT n.file, max(f.tm) - 3000 AS mark FROM (SELECT unnest([1, 2, 3]) AS file) n JOIN f ON f.file < n.file GROUP BY 1),
k AS (SELECT sku_id, sku_num, tm // 60000 * 60000 AS stt,
  CASE WHEN tm IS NULL THEN 'dirty' WHEN tm // 60000 * 60000 + 60000 <= mark THEN 'late' ELSE 'window' END AS kind
  FROM f LEFT JOIN h ON f.file = h.file)
SELECT kind, stt, sku_id, count(*) AS order_ct, CAST(sum(sku_num) AS BIGINT) AS sku_num FROM k GROUP BY ALL"""
    q["stream_payment_idle"] = f"""WITH {EV}, {LINES},
third AS (SELECT min(epoch_us(ts) // 1000) AS low, max(epoch_us(ts) // 1000) AS high FROM ev),
paid AS (SELECT ev.* FROM ev, third WHERE (epoch_us(ts) // 1000 - low) * 3 < high - low + 1),
{PAY.replace("FROM ev b", "FROM paid b")} {pmin}"""
    q["stream_log_bus"] = f"""WITH {EV}, {GOOD}, f AS (
  SELECT *, CASE WHEN dt = min(dt) OVER (PARTITION BY user_id) THEN '1' ELSE '0' END AS is_new FROM good), x AS (
  SELECT 'err' AS kind, '-' AS is_new FROM f WHERE event_type = 'error'
  UNION ALL SELECT 'start', is_new FROM f WHERE event_type = 'signup'
  UNION ALL SELECT 'display', is_new FROM f, (SELECT unnest([1, 2])) WHERE event_type = 'view'
  UNION ALL SELECT 'action', is_new FROM f WHERE event_type = 'click'
  UNION ALL SELECT 'page', is_new FROM f WHERE event_type <> 'signup'
  UNION ALL SELECT 'dirty', '-' FROM ev WHERE k % 50 = 0)
SELECT kind, is_new, count(*) AS n FROM x GROUP BY ALL"""
    q["stream_action_minute"] = f"WITH {EV}, {ACT_MIN} SELECT * FROM amin"
    q["stream_visit_minute"] = f"WITH {EV}, {VISIT_MIN} SELECT * FROM vmin"
    q["stream_trade_daily"] = f"WITH {ALL_MIN} SELECT {DAY}, sku_id, {ORDER_SUMS}, {PAY_SUMS}, {REF_SUMS} FROM u GROUP BY 1, 2"
    q["stream_overview_daily"] = f"""WITH {ALL_MIN}, d AS (SELECT {DAY}, {ORDER_SUMS}, {PAY_SUMS}, {REF_SUMS} FROM u GROUP BY 1)
SELECT *, CASE WHEN payment_user_ct = 0 THEN 0 ELSE payment_amount / payment_user_ct END AS arp FROM d"""
    q["stream_funnel_daily"] = f"""WITH {EV}, {ORDER_MIN}, {PAY}, {ACT_MIN}, u AS (
  SELECT stt, sku_id, order_user_ct FROM omin UNION ALL BY NAME SELECT stt, sku_id, payment_user_ct FROM pmin
  UNION ALL BY NAME SELECT * REPLACE (CAST(sku_id AS BIGINT) AS sku_id) FROM amin)
SELECT {DAY}, sku_id, {", ".join(z(m) for m in ("exposure_ct", "click_ct", "cart_ct", "favor_ct", "order_user_ct", "payment_user_ct"))}
FROM u GROUP BY 1, 2"""
    acts = [f"{m}_{x}" for m in ("exposure", "click", "favor", "cart") for x in ("ct", "user_ct")]
    q["stream_action_daily"] = f"WITH {EV}, {ACT_MIN} SELECT {DAY}, sku_id, {', '.join(z(a) for a in acts)} FROM amin GROUP BY 1, 2"
    visits = ", ".join(z(m) for m in ("pv", "uv", "duration_ms", "bounce_ct", "session_ct"))
    q["stream_visit_daily"] = f"WITH {EV}, {VISIT_MIN} SELECT {DAY}, {visits} FROM vmin GROUP BY 1"
    q["stream_db_router"] = ROUTED
    q["stream_cdc_log"] = ROUTED
    q["stream_event_log"] = f"""WITH {EV} SELECT 'log_' || event_type AS topic, event_id, user_id, epoch_us(ts) // 1000 AS ts_ms
FROM ev WHERE k % 50 <> 0"""
    q["stream_dim_bus"] = CUSTOMER_DIM
    q["config_bus"] = """SELECT CASE WHEN t < 20 THEN 'dim_customer' WHEN t < 40 THEN 'dim_buyer' WHEN t < 80 THEN 'dim_customer' ELSE 'dim_client' END AS sink_table,
  md5(CASE WHEN t < 40 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END) AS row_key,
  'c_custkey=' || c_custkey || ',c_mktsegment=' || c_mktsegment || ',c_name=' || c_name || ',c_nationkey=' || c_nationkey AS columns,
  t AS ts_ms FROM (SELECT *, c_custkey % 100 AS t FROM customer) WHERE c_custkey % 10 <> 0 AND NOT t BETWEEN 40 AND 59"""
    q["stream_ods_bootstrap"] = f"""WITH {ODS}, x AS (SELECT 'ods_mysql_' || tab || '_raw' AS topic FROM ods
  UNION ALL SELECT 'ods_mysql_' || tab FROM ods WHERE op <> 'd') SELECT topic, count(*) AS n FROM x GROUP BY 1"""
    q["stream_dwd_base"] = f"""WITH {ODS} SELECT {DWD_TOPIC} AS topic, CAST(dt AS VARCHAR) AS dt, count(*) AS n FROM ods WHERE op <> 'd'
GROUP BY ALL"""
    q["stream_user_dim"] = f"""WITH {ODS}, u AS (SELECT CAST(key AS VARCHAR) AS cell, ts_ms FROM ods
  WHERE tab = 'ods_user_info' AND op IN ('c', 'u'))
SELECT {salted("dim_user_info", "cell")} AS row_key, ts_ms, 'order_detail_id=' || cell || ',order_id=' || cell || ',pay_id=' || cell ||
  ',refund_id=' || cell || ',user_id=' || cell AS cells FROM u"""
    q["stream_comment_join"] = f"WITH {EV}, {COMMENT} SELECT * FROM cj"
    q["stream_moderation"] = f"""WITH {EV}, {COMMENT}, m AS (SELECT *, split_part("commentTxt", ',', -1) AS w FROM cj)
SELECT user_id, info_consignee AS consignee, ts_ms, ds, "commentTxt" AS msg, CASE WHEN r_name IS NULL THEN 0 ELSE 1 END AS is_violation,
  CASE WHEN r_name IS NULL THEN '' ELSE 'P0' END AS violation_grade, CASE WHEN r_name IS NULL THEN '' ELSE w END AS violation_msg
FROM m LEFT JOIN region ON w = 'w' || r_regionkey"""
    q["stream_dedup"] = f"SELECT event_id, user_id, strftime(ts, {TIME}) AS ts FROM events"
    q["stream_keep_newest"] = """SELECT user_id, max_by(event_id, ts) AS event_id, epoch_us(max(ts)) AS "at" FROM events GROUP BY 1"""
    q["stream_is_new"] = f"""WITH {EV} SELECT event_id, 'm' || user_id AS mid, epoch_us(ts) // 1000 AS ts,
  CASE WHEN dt = min(dt) OVER (PARTITION BY user_id) THEN '1' ELSE '0' END AS is_new FROM ev"""
    q["stream_dedup_bloom"] = """SELECT event_id, user_id, user_id || '_' || (epoch_us(ts) // 1000) AS key FROM events"""
    return q
