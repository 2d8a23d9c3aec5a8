"""SQL counterparts of the registered queries, for the correctness check."""

from __future__ import annotations

from oracles import logistics, operators, retail, streams, traffic


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (retail, logistics, traffic, operators, streams):
        out.update(part.sql())
    # What is stored day by day must equal the same over all source rows up to the last day.
    day = retail.ORDER_DAY
    for runner, job in {
        "retail_order_stats": "retail_ads_order_stats_by_tm", "retail_order_to_date": "retail_dws_trade_user_order_td",
        "retail_order_to_pay": "retail_ads_order_to_pay_interval_avg", "retail_login_to_date": "retail_dws_user_user_login_td",
        "logistics_under_way": "logistics_ads_trans_order_stats_td", "logistics_trans_order": "logistics_ads_trans_order_stats",
        "traffic_section_visit": "traffic_ads_section_visit", "traffic_user_history": "traffic_dim_user_zip",
    }.items():
        out[f"runner_{runner}"] = out[job]
    out["runner_retail_user_history"] = retail.user_history(day)
    out["runner_logistics_waybill_reached"] = f"""SELECT * EXCLUDE (dt) FROM ({
        logistics.waybill_reached(f"WHERE moment < {day} + INTERVAL 1 DAY")})"""
    out["runner_logistics_sign"] = f"SELECT * FROM ({out['logistics_dwd_trans_sign_detail_inc']}) WHERE CAST(dt AS DATE) BETWEEN {day} - 31 AND {day}"
    return out
