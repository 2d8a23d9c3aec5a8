"""Slowly changing history (open interval until 9999-12-31)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.operators.sequences import latest

OPEN_END = "9999-12-31"


def scd2_init(df: DataFrame, start: Column) -> DataFrame:
    """First load: every row is the open version of its key."""
    return df.withColumns({"start_date": start, "end_date": F.lit(OPEN_END).cast("date")})


def scd2_merge(open_rows: DataFrame, changes: DataFrame, key: str, effective: str, order: Sequence[str]) -> DataFrame:
    """Open versions plus changed rows.

    ``effective`` is the day a change takes effect; several changes of a key on one day collapse to the newest by
    ``order``. A version ends the day before the next one starts, the newest stays open and start dates of known
    versions are kept. A change on the start day of the open version replaces it. After the collapse a key has at
    most one row per day, so the window below is bounded by the calendar.
    """
    attributes = [c for c in open_rows.columns if c not in ("start_date", "end_date")]
    per_day = latest(changes, [key, effective], order)
    old = open_rows.select(*attributes, "start_date", F.lit(0).alias("__new"))
    new = per_day.select(*attributes, F.col(effective).cast("date").alias("start_date"), F.lit(1).alias("__new"))
    versions = latest(old.unionByName(new), [key, "start_date"], ["__new"]).drop("__new")
    following = F.lead("start_date").over(Window.partitionBy(key).orderBy("start_date"))
    end = F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END).cast("date"))
    return versions.withColumn("end_date", end).select(*attributes, "start_date", "end_date")


def scd2_reopen(rows: DataFrame, first: str) -> DataFrame:
    """Versions as they stood on the eve of ``first``: what that day or a later one closed is open again."""
    day = F.lit(first).cast("date")
    known = rows.where(F.col("start_date") < day)
    open_then = F.col("end_date") >= F.date_sub(day, 1)
    return known.withColumn("end_date", F.when(open_then, F.lit(OPEN_END).cast("date")).otherwise(F.col("end_date"))).drop("dt")


def closed_on(end: Column) -> Column:
    """The day whose changes closed a version that ends on ``end``."""
    return F.when(end == F.lit(OPEN_END).cast("date"), end).otherwise(F.date_add(end, 1))
