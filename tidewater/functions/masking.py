"""Masking of personal data. Every function returns null for a value that does not look valid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide whether a phone number or an e-mail address is kept, for the first load (short
# masks) and for the daily merge (middle masks).
PHONE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"
MERGE_PHONE = r"^1[3-9][0-9]{9}$"
MERGE_EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"


def mask_name(c: Column) -> Column:
    """First character and a star."""
    return F.concat(F.substring(c, 1, 1), F.lit("*"))


def mask_phone(c: Column, style: str = "short") -> Column:
    """``short`` gives ``138*``, ``middle`` gives ``138****5678``."""
    if style == "short":
        masked = F.concat(F.substring(c, 1, 3), F.lit("*"))
    elif style == "middle":
        masked = F.concat(F.substring(c, 1, 3), F.lit("****"), F.substring(c, 8, 4))
    else:
        raise ValueError(f"unknown phone mask {style!r}")
    return F.when(c.rlike(PHONE if style == "short" else MERGE_PHONE), masked)


def mask_email(c: Column, style: str = "short") -> Column:
    """``short`` gives ``*@domain``, ``middle`` gives ``***@domain``."""
    stars = {"short": "*@", "middle": "***@"}[style]
    return F.when(c.rlike(EMAIL if style == "short" else MERGE_EMAIL), F.concat(F.lit(stars), F.split(c, "@")[1]))


def anon(c: Column, pattern: str | None = None) -> Column:
    """MD5 of the value, or null when ``pattern`` is given and does not match."""
    return F.md5(c if pattern is None else F.when(c.rlike(pattern), c))
