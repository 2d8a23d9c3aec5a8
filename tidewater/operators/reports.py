"""Report patterns: paths, retention, repeat purchase, shares, driver split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.functions import ratio, step_label
from tidewater.operators.rollups import in_days
from tidewater.operators.sequences import sequence_rows


def page_path(views: DataFrame, session: Sequence[str], order: Sequence[str], page: str, bucket: Column) -> DataFrame:
    """How often each step leads to which next step; the last step of a session leads to ``null``."""
    steps = sequence_rows(views, session, order, bucket, next_of={"__next": page}, index="__rn")
    labelled = steps.select(
        step_label(F.col("__rn"), F.col(page)).alias("source"),
        F.coalesce(step_label(F.col("__rn") + 1, F.col("__next")), F.lit("null")).alias("target"),
    )
    return labelled.groupBy("source", "target").agg(F.count(F.lit(1)).alias("path_count"))


def churned(logins: DataFrame, base: str, days: int = 7) -> DataFrame:
    """Users whose last login was exactly ``days`` days before ``base``."""
    gone = F.col("login_date_last") == F.date_sub(F.lit(base).cast("date"), days)
    return logins.where(gone).agg(F.count(F.lit(1)).alias("user_churn_count"))


def returned(today: DataFrame, previous: DataFrame, base: str, gap: int = 8) -> DataFrame:
    """Users back on ``base`` after at least ``gap`` days; both inputs hold one row per user."""
    back = today.where(F.col("login_date_last") == F.lit(base).cast("date")).select("user_id", "login_date_last")
    before = previous.select("user_id", F.col("login_date_last").alias("login_date_previous"))
    both = back.join(before, "user_id").where(F.datediff("login_date_last", "login_date_previous") >= gap)
    return both.agg(F.count(F.lit(1)).alias("user_back_count"))


def active_users(logins: DataFrame, base: str, days: Sequence[int]) -> DataFrame:
    """New and active users per window from the to-date login table: one aggregate, one row."""
    bounded = logins.where(in_days(F.col("login_date_last"), base, max(days)))
    first, last = F.col("login_date_first"), F.col("login_date_last")
    counts = bounded.agg(
        *[
            c
            for n in days
            for c in (
                F.count(F.when(in_days(last, base, n) & in_days(first, base, n), 1)).alias(f"new_{n}"),
                F.count(F.when(in_days(last, base, n), 1)).alias(f"active_{n}"),
            )
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("recent_days"),
                F.col(f"new_{n}").alias("new_user_count"),
                F.col(f"active_{n}").alias("active_user_count"),
            )
            for n in days
        ]
    )
    return counts.select(F.inline(rows)).where(F.col("active_user_count") > 0)


def repeat_rate(orders: DataFrame, entity: str, keys: Sequence[str], count: str, out: str) -> DataFrame:
    """Share of buyers per key with two or more orders."""
    per_buyer = orders.groupBy(entity, *keys).agg(F.sum(count).alias("__n"))
    rate = ratio(F.count(F.when(F.col("__n") >= 2, 1)), F.count(F.when(F.col("__n") >= 1, 1)))
    return per_buyer.groupBy(*keys).agg(rate.alias(out))


def share_of(df: DataFrame, group: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Share of each row in the sum of its group; ``measures`` maps output to input columns. ``df`` is an aggregate with one
    row per group and part, which is read once; parts of no group have no share."""
    whole = Window.partitionBy(*group)
    return df.dropna(subset=list(group)).select(
        *[c for c in df.columns if c not in measures.values()],
        *[F.try_divide(F.col(src).cast("double"), F.sum(src).over(whole)).alias(out) for out, src in measures.items()])


def driver_split(trips: DataFrame, halves: Sequence[str], whole: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per driver. Two drivers share distance and time in halves; counts belong to both in full."""
    pair = F.filter(
        F.array(
            F.struct(F.col("driver1_emp_id").alias("id"), F.col("driver1_name").alias("name")),
            F.struct(F.col("driver2_emp_id").alias("id"), F.col("driver2_name").alias("name")),
        ),
        lambda d: d["id"].isNotNull(),
    )
    two = F.col("driver2_emp_id").isNotNull()
    rows = trips.select(
        *keep,
        *[F.when(two, F.col(c) / 2).otherwise(F.col(c)).alias(c) for c in halves],
        *whole,
        F.explode(pair).alias("__d"),
    )
    return rows.withColumns({"driver_emp_id": F.col("__d.id"), "driver_name": F.col("__d.name")}).drop("__d")


def interval_avg(df: DataFrame, start: str, end: str) -> DataFrame:
    """Mean seconds between two timestamps."""
    gap = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return df.agg(F.floor(F.avg(gap)).cast("bigint").alias("interval_avg"))
