"""Row keys and hash buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_mod(c: Column, n: int, overrides: dict[str, str] | None = None) -> Column:
    """Bucket from the last three hex digits of the MD5, padded to four digits.

    ``overrides`` maps a lower-case key to the bucket it always gets.
    """
    text = c.cast("string")
    digits = F.conv(F.substring(F.md5(text), 30, 3), 16, 10).cast("int")
    bucket = F.lpad((digits % n).cast("string"), 4, "0")
    for key, fixed in (overrides or {}).items():
        bucket = F.when(F.lower(text) == key, F.lit(fixed)).otherwise(bucket)
    return bucket


def java_string_hash(c: Column) -> Column:
    """``String.hashCode`` of a text in the basic plane, as a non-negative 32-bit number."""
    codes = F.transform(F.split(c, ""), lambda x: F.ascii(x).cast("bigint"))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda acc, x: (acc * 31 + x) % 4294967296)


def salted_key(prefix: str, c: Column, buckets: int = 16) -> Column:
    """``prefix_id_bb``: the bucket spreads neighbouring ids over the key range."""
    text = c.cast("string")
    bucket = java_string_hash(text).bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")) % buckets
    return F.concat_ws("_", F.lit(prefix), text, F.lpad(bucket.cast("string"), 2, "0"))
