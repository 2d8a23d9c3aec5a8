"""Text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Benefit rule texts by type code. Each entry lists the literal parts and the argument names.
RULE_TEXTS = {
    "3201": ("满", "condition_amount", "元减", "benefit_amount", "元"),
    "3202": ("满", "condition_num", "件打", "benefit_discount", " 折"),
    "3203": ("减", "benefit_amount", "元"),
    "3101": ("满", "condition_amount", "元减", "benefit_amount", "元"),
    "3102": ("满", "condition_num", "件打", "benefit_discount", " 折"),
    "3103": ("打", "benefit_discount", "折"),
}
RULE_ARGS = ("condition_amount", "condition_num", "benefit_amount", "benefit_discount")


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def rule_text(code: Column, family: str) -> Column:
    """Readable benefit rule for the type codes that start with ``family`` ("32" coupons, "31" activities)."""
    out = F.lit(None).cast("string")
    for value, parts in RULE_TEXTS.items():
        if value.startswith(family):
            text = F.concat(*[F.col(p).cast("string") if p in RULE_ARGS else F.lit(p) for p in parts])
            out = F.when(code.cast("string") == value, text).otherwise(out)
    return out


def step_label(n: Column, page: Column) -> Column:
    """``step-n:page``, null when there is no page."""
    return F.concat(F.lit("step-"), n.cast("string"), F.lit(":"), page)


def visitor_id(uid: Column, mid: Column, *fallbacks: Column) -> Column:
    """Account id if usable, else device id, else the fallbacks in order."""
    usable = F.when((uid != "") & (F.lower(uid) != "null"), uid)
    return F.coalesce(usable, F.when(mid != "", mid), *fallbacks)


def last_token(c: Column, separator: str = ",") -> Column:
    """Part after the last separator that is not followed by empty parts only."""
    return F.element_at(F.split(F.regexp_replace(c, f"[{separator}]+$", ""), separator), -1)


def parsed_once(parsed: Column) -> Column:
    """Keep a costly expression from being repeated.

    A filter on its result would otherwise be pushed below it as a copy, one per field that is tested. Rows that
    come out of a generator are filtered afterwards; the one-element array gives exactly one row each.
    """
    return F.explode_outer(F.array(parsed))
