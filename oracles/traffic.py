"""Traffic queries."""

from __future__ import annotations

from oracles.retail import EV, EVENT_DAY

VISIT = """vis AS (
  SELECT event_id AS visit_id, user_id, user_id || '-' || dt AS session_id, '/p/' || (k % 40) AS page_url,
         CASE WHEN user_id % 2 = 0 THEN 'wireless' ELSE 'pc' END AS device, ts, event_type, dt
  FROM ev WHERE event_type <> 'error')"""

WIDE = """raw AS (
  SELECT event_id AS log_id, user_id, CASE WHEN k % 3 = 0 THEN k % 5 END AS shop, CASE WHEN k % 3 = 1 THEN k % 10 END AS sec,
         CASE WHEN k % 3 = 2 THEN k % 20 END AS spu, k, CAST(floor(value) AS BIGINT) AS during_time, ts, dt FROM ev),
w0 AS (SELECT * EXCLUDE (sec), coalesce(spu % 10, sec) AS sec FROM raw),
w1 AS (SELECT * EXCLUDE (shop), coalesce(sec % 5, shop) AS shop FROM w0),
wide AS (
  SELECT log_id, user_id, 'shop' || shop AS shop_id, 'sec' || sec AS section_id, 'spu' || spu AS spu_id,
         list_extract(['shop', 'section', 'item'], CAST(k % 3 + 1 AS INTEGER)) AS page_type, during_time, ts, dt,
         'Spu ' || spu AS spu_name, 'Section ' || sec AS section_name, 'Shop ' || shop AS shop_name FROM w1)"""


def within(n: int, dt: str = "dt") -> str:
    return f"{dt} BETWEEN {EVENT_DAY} - {n - 1} AND {EVENT_DAY}"


def per_days(expr: str, out: str) -> str:
    return ", ".join(expr.format(w=within(n)) + f" AS {out}_{n}d" for n in (1, 7, 30))


def visits(keys: str) -> str:
    counts = per_days("count(*) FILTER ({w})", "visit_count")
    return f"""SELECT {keys}, {counts} FROM wide WHERE {keys.split(",")[-2].strip()} IS NOT NULL AND {within(30)} GROUP BY ALL"""


def ratios(group: str, part: str) -> str:
    shares = ", ".join(
        f"CASE WHEN sum(visit_count_{n}d) OVER g > 0 THEN CAST(visit_count_{n}d AS DOUBLE) / sum(visit_count_{n}d) OVER g END AS ratio_{n}d"
        for n in (1, 7, 30))
    return f"""WITH {EV}, {WIDE}, v AS ({visits(f"{group}, {part}")})
SELECT '2024-01-30' AS dt, {group}, {part}, {shares} FROM v WINDOW g AS (PARTITION BY {group})"""


def sql() -> dict[str, str]:
    q = {}
    q["ads_wireless_entry"] = f"""WITH {EV}, {VISIT},
  e AS (SELECT DISTINCT dt, page_url, user_id FROM vis WHERE device = 'wireless' AND event_type = 'view' AND {within(30)}),
  b AS (SELECT DISTINCT dt, user_id FROM vis WHERE device = 'wireless' AND event_type = 'purchase' AND {within(30)}),
  m AS (SELECT e.*, b.user_id IS NOT NULL AS bought FROM e LEFT JOIN b ON e.dt = b.dt AND e.user_id = b.user_id)
SELECT '2024-01-30' AS dt, page_url, {per_days("count(DISTINCT user_id) FILTER ({w})", "visitor_count")},
  {per_days("count(DISTINCT user_id) FILTER (bought AND {w})", "buyer_count")} FROM m GROUP BY ALL"""
    q["ads_page_visit_rank"] = f"""WITH {EV}, {VISIT}, s AS (
  SELECT *, lead(ts) OVER (PARTITION BY session_id ORDER BY ts, visit_id) AS nxt FROM vis WHERE dt = {EVENT_DAY}),
  p AS (SELECT page_url, count(DISTINCT user_id) AS visitor_count,
          CAST(floor(sum(floor(epoch(nxt)) - floor(epoch(ts))) / count(nxt)) AS BIGINT) AS avg_stay_sec FROM s GROUP BY 1)
SELECT '2024-01-30' AS dt, *, rank() OVER (ORDER BY visitor_count DESC) AS rk FROM p"""
    q["ads_in_store_path"] = f"""WITH {EV}, {VISIT}, s AS (
  SELECT page_url AS source_page, lead(page_url) OVER (PARTITION BY session_id ORDER BY ts, visit_id) AS target_page
  FROM vis WHERE dt = {EVENT_DAY})
SELECT '2024-01-30' AS dt, source_page, target_page, count(*) AS visitor_count FROM s WHERE target_page IS NOT NULL GROUP BY ALL"""
    q["ads_pc_source"] = f"""WITH {EV}, {VISIT}, c AS (
  SELECT page_url, count(DISTINCT user_id) AS visitors FROM vis WHERE dt = {EVENT_DAY} AND device = 'pc' GROUP BY 1),
  s AS (SELECT sum(visitors) AS a FROM c)
SELECT '2024-01-30' AS dt, page_url, visitors, CAST(visitors AS DOUBLE) / a AS share FROM c, s ORDER BY visitors DESC, page_url LIMIT 20"""
    q["dwd_logs_wide"] = f"""WITH {EV}, {WIDE} SELECT * EXCLUDE (ts, dt), strftime(ts, '%Y-%m-%d %H:%M:%S') AS request_time,
  CAST(dt AS VARCHAR) AS dt FROM wide"""
    for table, keys in [("ads_spu_visit", "spu_id, spu_name"), ("ads_section_visit", "section_id, section_name"),
                        ("ads_shop_visit", "shop_id, shop_name")]:
        q[table] = f"WITH {EV}, {WIDE} SELECT '2024-01-30' AS dt, * FROM ({visits(keys)})"
    q["ads_section_spu_ratio"] = ratios("section_id, section_name", "spu_id, spu_name")
    q["ads_shop_section_ratio"] = ratios("shop_id, shop_name", "section_id, section_name")
    stays = ", ".join(
        f"CAST(sum(during_time) FILTER ({within(n)}) AS DOUBLE) / count(*) FILTER ({within(n)}) AS avg_stay_time_{n}d"
        for n in (1, 7, 30))
    q["ads_shop_avg_stay"] = f"""WITH {EV}, {WIDE} SELECT '2024-01-30' AS dt, shop_id, shop_name, {stays}
FROM wide WHERE shop_id IS NOT NULL AND {within(30)} GROUP BY ALL"""
    q["dim_user_zip"] = f"""WITH {EV}, ch AS (
  SELECT user_id, 'level ' || k AS level, dt AS start_date, row_number() OVER (PARTITION BY user_id, dt ORDER BY ts DESC) AS rn
  FROM ev WHERE event_type = 'signup'),
  v AS (SELECT user_id, level, start_date FROM ch WHERE rn = 1
        UNION ALL SELECT c_custkey, c_mktsegment, DATE '2023-12-31' FROM customer)
SELECT user_id, level, CAST(start_date AS VARCHAR) AS start_date,
  CAST(coalesce(lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) - 1, DATE '9999-12-31') AS VARCHAR) AS end_date FROM v"""
    return {f"traffic_{k}": v for k, v in q.items()}
