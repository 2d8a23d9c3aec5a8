from tidewater.functions.keys import hash_mod, java_string_hash, salted_key
from tidewater.functions.masking import anon, mask_email, mask_name, mask_phone
from tidewater.functions.text import is_blank, last_token, parsed_once, rule_text, step_label, visitor_id
from tidewater.functions.times import (
    add_day,
    day_range,
    duration_sec,
    event_ts,
    fmt_day,
    iso_trim,
    ms_to_date,
    ms_to_time,
)
from tidewater.functions.values import cond_sum, money, ratio

__all__ = [
    "add_day", "anon", "cond_sum", "day_range", "duration_sec", "event_ts", "fmt_day", "hash_mod", "is_blank",
    "iso_trim", "java_string_hash", "last_token", "mask_email", "mask_name", "mask_phone", "money", "ms_to_date",
    "ms_to_time", "parsed_once", "ratio", "rule_text", "salted_key", "step_label", "visitor_id",
]
