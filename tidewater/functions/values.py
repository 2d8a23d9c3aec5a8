"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    """Amounts are exact decimals; bare ``decimal`` would drop the cents."""
    return c.cast("decimal(18,2)")


def cond_sum(value: Column, predicate: Column) -> Column:
    return F.sum(F.when(predicate, value).otherwise(F.lit(0)))


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """Quotient as decimal, null when the denominator is zero."""
    return F.try_divide(num, den).cast(f"decimal(16,{scale})")
