"""Event time and interval joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import event_ts


#: Epoch milliseconds of a row that only moves the watermark (see ``streaming.lateness``); null in all other rows.
HEARTBEAT = "heartbeat"


def with_event_time(
    df: DataFrame, fields: str | Sequence[str], delay: str = "3 seconds", out: str = "event_ts",
    unit: str = "milliseconds",
) -> DataFrame:
    """Event timestamp from the first of ``fields`` that is set, with a watermark.

    Rows without any time are left out here; take them from :func:`without_event_time`, or from the dirty output of
    ``lateness.sorting_sink``, whose heartbeats move the watermark and go no further. A delay of ``0 seconds`` suits
    input that is ordered by time.
    """
    ts = _event_time(fields, unit)
    timed = df.withColumn(out, ts).where(F.col(out).isNotNull()).withWatermark(out, delay)
    if HEARTBEAT not in df.columns:
        return timed
    # Filter and columns name the event time, so that Spark leaves them, and what later steps ask of the columns, above the
    # watermark; the null filter of a join would else take heartbeats away before they move it.
    real = F.coalesce(F.unix_millis(out) != F.col(HEARTBEAT), F.lit(True))
    return timed.where(real).select(*[F.when(real, F.col(c)).alias(c) for c in df.columns if c not in (HEARTBEAT, out)], out)


def without_event_time(df: DataFrame, fields: str | Sequence[str], unit: str = "milliseconds") -> DataFrame:
    return df.where(_event_time(fields, unit).isNull())


def _event_time(fields: str | Sequence[str], unit: str) -> Column:
    names = [fields] if isinstance(fields, str) else list(fields)
    epoch = event_ts(*[F.col(n) for n in names])
    return F.timestamp_millis(epoch if unit == "milliseconds" else epoch * 1000)


def interval_join(
    left: DataFrame, right: DataFrame, on: tuple[str, str], times: tuple[str, str], lower: int, upper: int,
    prefix: str = "",
) -> DataFrame:
    """Pairs of equal key whose right time lies in ``[left + lower, left + upper]`` seconds.

    Time is cut into slices as wide as the interval and the slice is part of the join key: a left row has one
    slice, a right row is copied into the two or three slices it can match. The rows of a hot key so spread over
    time slices, and only rows near each other in time meet. The exact bounds stay in the condition, from which a
    stream derives when it can forget rows. ``prefix`` goes before every right column.
    """
    left_key, right_key = on
    left_ts, right_ts = times
    width = max(upper - lower, 1)

    def slice_of(seconds: Column) -> Column:
        return F.floor(seconds / width).cast("bigint")

    named = right.select(*[F.col(c).alias(f"{prefix}{c}") for c in right.columns])
    r_key, r_ts = f"{prefix}{right_key}", f"{prefix}{right_ts}"
    seconds = F.unix_seconds(F.col(r_ts))
    sliced = named.withColumn("__rs", F.explode(F.sequence(slice_of(seconds - upper), slice_of(seconds - lower))))
    anchored = left.withColumn("__ls", slice_of(F.unix_seconds(F.col(left_ts))))
    bounds = (
        (F.col(r_ts) >= F.col(left_ts) + F.expr(f"INTERVAL {lower} SECONDS"))
        & (F.col(r_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {upper} SECONDS"))
    )
    same = (anchored[left_key] == sliced[r_key]) & (F.col("__ls") == F.col("__rs"))
    return anchored.join(sliced, same & bounds, "inner").drop("__ls", "__rs")
