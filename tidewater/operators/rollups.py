"""One-day, n-day and to-date roll-ups.

Every roll-up is a plain grouped aggregate, so Spark combines rows on the map side before the shuffle and a hot
key costs one partial row per task. Distinct counts are taken in two levels (first per key and entity, then per
key), which spreads a hot key over its entities.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Measures = Mapping[str, Column | str]


def one_day(df: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """Group and aggregate; a measure given as text is the sum of that column."""
    return df.groupBy(*keys).agg(*_aggs(measures))


def total(df: DataFrame, measures: Measures) -> DataFrame:
    """One row over everything, also for empty input."""
    return df.agg(*_aggs(measures))


def to_date(df: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """All history, no date bound."""
    return df.groupBy(*keys).agg(*_aggs(measures)) if keys else total(df, measures)


def dedup_sum(
    df: DataFrame, id_col: str, keys: Sequence[str], amount: str, count_as: str, amount_as: str | None
) -> DataFrame:
    """Count ids and add up an amount that repeats on every line of the id."""
    order = df.groupBy(id_col, *keys).agg(F.max(amount).alias("__amount"))
    aggs = [F.count(id_col).alias(count_as)]
    if amount_as:
        aggs.append(F.sum("__amount").alias(amount_as))
    return order.groupBy(*keys).agg(*aggs) if keys else order.agg(*aggs)


def distinct_count(
    df: DataFrame, keys: Sequence[str], entity: str, out: str, measures: Measures | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Distinct entities per key, together with sums. ``where`` restricts which rows make an entity count."""
    measures = measures or {}
    seen = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    per_entity = df.groupBy(*keys, entity).agg(F.max(seen).alias("__seen"), *_aggs(measures))
    return per_entity.groupBy(*keys).agg(
        F.count(F.when(F.col("__seen"), F.col(entity))).alias(out), *[F.sum(m).alias(m) for m in measures]
    )


def first_last_avg(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(col).alias(f"{col}_first"), F.max(col).alias(f"{col}_last"), F.avg(col).alias(f"{col}_avg")
    )


def in_days(dt: Column, base: str, days: int) -> Column:
    """``dt`` lies in the last ``days`` days up to and including ``base``."""
    last = F.lit(base).cast("date")
    return (dt >= F.date_sub(last, days - 1)) & (dt <= last)


def n_day_columns(
    df: DataFrame, base: str, days: Sequence[int], keys: Sequence[str], measures: Mapping[str, str], dt: str = "dt"
) -> DataFrame:
    """Columns ``<measure>_<n>d``. The widest window is a filter on the scan; one pass feeds all windows."""
    wide = df.where(in_days(F.col(dt), base, max(days)))
    return wide.groupBy(*keys).agg(
        *[
            F.sum(F.when(in_days(F.col(dt), base, n), F.col(src)).otherwise(F.lit(0))).alias(f"{out}_{n}d")
            for n in days
            for out, src in measures.items()
        ]
    )


def n_day_rows(
    df: DataFrame, base: str, days: Sequence[int], keys: Sequence[str], measures: Mapping[str, str | Column],
    dt: str = "dt",
) -> DataFrame:
    """One row per key and window (``recent_days``) that holds any data.

    Instead of copying each input row once per window, the windows become columns of a single aggregate and are
    turned into rows afterwards, so the shuffle carries one partial row per key and task. Measures are sums; a
    measure given as a column is summed too.
    """
    wide = df.where(in_days(F.col(dt), base, max(days)))
    aggs = []
    for n in days:
        inside = in_days(F.col(dt), base, n)
        aggs.append(F.count(F.when(inside, F.lit(1))).alias(f"__n_{n}"))
        for out, src in measures.items():
            value = F.col(src) if isinstance(src, str) else src
            aggs.append(F.sum(F.when(inside, value)).alias(f"{out}__{n}"))
    grouped = wide.groupBy(*keys).agg(*aggs) if keys else wide.agg(*aggs)
    rows = _unpivot(grouped, days, ["__n", *measures], lambda m, n: f"__n_{n}" if m == "__n" else f"{m}__{n}", keys)
    return rows.where(F.col("__n") > 0).drop("__n")


def n_day_entities(
    df: DataFrame, base: str, days: Sequence[int], keys: Sequence[str], entity: str, distinct_as: str,
    measures: Mapping[str, Column], dt: str = "dt",
) -> DataFrame:
    """Windows as rows, with the distinct entities of each window.

    An entity is in the n-day window exactly when its latest day is, so one pass per (key, entity) answers all
    windows: no copying of rows and no separate distinct per window.
    """
    wide = df.where(in_days(F.col(dt), base, max(days)))
    aggs = [F.max(dt).alias("__last")]
    for n in days:
        inside = in_days(F.col(dt), base, n)
        aggs += [F.sum(F.when(inside, value)).alias(f"{out}__{n}") for out, value in measures.items()]
    per_entity = wide.groupBy(*keys, entity).agg(*aggs)
    per_key = per_entity.groupBy(*keys).agg(
        *[
            a
            for n in days
            for a in (
                F.count(F.when(in_days(F.col("__last"), base, n), F.lit(1))).alias(f"__n__{n}"),
                F.count(F.when(in_days(F.col("__last"), base, n), F.col(entity))).alias(f"{distinct_as}__{n}"),
                *[F.sum(f"{out}__{n}").alias(f"{out}__{n}") for out in measures],
            )
        ]
    )
    rows = _unpivot(per_key, days, ["__n", distinct_as, *measures], lambda m, n: f"{m}__{n}", keys)
    return rows.where(F.col("__n") > 0).drop("__n")


def unpivot_days(df: DataFrame, days: Sequence[int], measures: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Turn ``<measure>_<n>d`` columns into rows with ``recent_days``."""
    return _unpivot(df, days, measures, lambda m, n: f"{m}_{n}d", keys)


def incremental_to_date(old: DataFrame, today: DataFrame, key: str, first: str, last: str,
                        sums: str | Sequence[str]) -> DataFrame:
    """Merge yesterday's totals with today's rows (both one row per key).

    A union and one aggregate do the work of a full outer join: one shuffle, and equal keys meet in the combine.
    """
    sums = [sums] if isinstance(sums, str) else list(sums)
    both = old.select(key, first, last, *sums).unionByName(today.select(key, first, last, *sums))
    return both.groupBy(key).agg(F.min(first).alias(first), F.max(last).alias(last), *[F.sum(s).cast(today.schema[s].dataType).alias(s) for s in sums])


def _unpivot(df, days, measures, source, keys) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(n).alias("recent_days"), *[F.col(source(m, n)).alias(m) for m in measures]) for n in days]
    )
    return df.select(*keys, F.inline(rows))


def _aggs(measures: Measures) -> list[Column]:
    return [(F.sum(m) if isinstance(m, str) else m).alias(out) for out, m in measures.items()]
