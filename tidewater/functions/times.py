"""Event time, day strings and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def iso_trim(c: Column) -> Column:
    """``2025-07-09T10:11:12Z`` becomes the text ``2025-07-09 10:11:12``."""
    return F.concat(F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 8))


def ms_to_time(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.timestamp_millis(c.cast("bigint")), fmt)


def ms_to_date(c: Column) -> Column:
    return F.to_date(F.timestamp_millis(c.cast("bigint")))


def duration_sec(start_ms: Column, end_ms: Column) -> Column:
    return F.floor((end_ms.cast("bigint") - start_ms.cast("bigint")) / 1000).cast("bigint")


def event_ts(*cols: Column) -> Column:
    """First epoch value that is present and not zero. There is no wall-clock fallback: a row without any time
    stays null and belongs in the dirty output."""
    return F.coalesce(*[F.nullif(c.cast("bigint"), F.lit(0).cast("bigint")) for c in cols])


def fmt_day(c: Column, fmt: str = "yyyyMMdd") -> Column:
    """Day text of an epoch in seconds or milliseconds; values under ten billion count as seconds."""
    n = c.cast("bigint")
    return F.date_format(F.timestamp_millis(F.when(n < 10_000_000_000, n * 1000).otherwise(n)), fmt)


def add_day(df: DataFrame, ts: str, name: str = "ds", fmt: str = "yyyyMMdd") -> DataFrame:
    return df.withColumn(name, F.date_format(F.timestamp_millis(F.col(ts).cast("bigint")), fmt))


def day_range(spark: SparkSession, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Partition numbers ``yyyyMMdd`` of all days from first to last."""
    days = F.sequence(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    each = spark.range(1).select(F.explode(days).alias("d"))
    return each.select(F.date_format("d", "yyyyMMdd").cast("int").alias("day"))
