"""Row order inside a key: next value, step number, latest version, consecutive days, top-k.

A window over a key sorts the whole key in one task. Where a key may be huge (one session, device or user with a
third of all rows) the sequence is therefore cut into buckets that follow the order, usually slices of time:
the windows run per (key, bucket), and a small table with one row per bucket supplies what crosses a boundary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Newest row per key, as an aggregate: rows are reduced before the shuffle."""
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def sequence_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    next_of: Mapping[str, str] | None = None,
    index: str | None = None,
) -> DataFrame:
    """Add the next row's value (``next_of``: new column -> source column) and the step number (``index``).

    ``bucket`` must not decrease along ``order``; ``order`` must be unique within a key.
    """
    next_of = next_of or {}
    df = df.withColumn("__b", bucket)
    inner = Window.partitionBy(*keys, "__b").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy("__b")

    first = F.struct(*order)
    per_bucket = df.groupBy(*keys, "__b").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.min_by(src, first).alias(f"__h_{out}") for out, src in next_of.items()],
    )
    edges = per_bucket.select(
        *keys,
        "__b",
        "__n",
        F.coalesce(
            F.sum("__n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
        *[F.lead(f"__h_{out}").over(across).alias(f"__x_{out}") for out in next_of],
    )
    position = F.row_number().over(inner)
    numbered = df.select(
        "*", position.alias("__pos"), *[F.lead(src).over(inner).alias(out) for out, src in next_of.items()]
    )
    right = edges.select(*[F.col(k).alias(f"__e{i}") for i, k in enumerate([*keys, "__b"])],
                         *[c for c in edges.columns if c.startswith("__") and c != "__b"])
    same = reduce(
        lambda a, b: a & b,
        [numbered[k].eqNullSafe(right[f"__e{i}"]) for i, k in enumerate([*keys, "__b"])],
    )
    joined = numbered.join(right, same, "inner")
    kept = [c for c in df.columns if c != "__b" and c not in next_of and c != index]
    columns = [F.col(c) for c in kept]
    columns += [
        F.when(F.col("__pos") == F.col("__n"), F.col(f"__x_{out}")).otherwise(F.col(out)).alias(out)
        for out in next_of
    ]
    if index:
        columns.append((F.col("__before") + F.col("__pos")).alias(index))
    return joined.select(*columns)


def next_value(df: DataFrame, keys, order, col: str, out: str, bucket: Column) -> DataFrame:
    return sequence_rows(df, keys, order, bucket, next_of={out: col})


def step_index(df: DataFrame, keys, order, out: str, bucket: Column) -> DataFrame:
    return sequence_rows(df, keys, order, bucket, index=out)


def consecutive_days(df: DataFrame, entity: str, dt: str, n: int) -> DataFrame:
    """Entities active on ``n`` days running.

    The days are made distinct first, so the window over an entity is bounded by the calendar.
    """
    days = df.select(entity, dt).distinct()
    ahead = F.lead(dt, n - 1).over(Window.partitionBy(entity).orderBy(dt))
    return days.withColumn("__ahead", ahead).where(F.datediff("__ahead", dt) == n - 1).select(entity).distinct()


def rank_in(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rk") -> DataFrame:
    return df.withColumn(out, F.rank().over(Window.partitionBy(*keys).orderBy(*order)))


def _cell(value: Column) -> Column:
    """A whole number that does not fall as the value rises: its binary order with six more bits, about 1.5 % wide."""
    size = F.abs(value.cast("double"))
    order = F.floor(F.log2(size))
    cell = (order + 1_100) * 128 + F.floor(size / F.pow(F.lit(2.0), order - 6))
    return F.when(value == 0, F.lit(0)).otherwise(F.when(value < 0, -cell).otherwise(cell)).cast("bigint")


def rank_all(df: DataFrame, value: str, out: str = "rk") -> DataFrame:
    """Rank over the whole table by a number, largest first, nulls last.

    Distinct values with their row counts are dealt to cells of neighbouring values. Ranks are counted inside the cells, and
    what lies in higher cells is added: the sums per cell are added up in one row, as there are only a few thousand cells
    however many rows. No task sorts the table, nor all its distinct values.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__n")).withColumn("__c", _cell(F.col(value)))
    cells = counts.groupBy("__c").agg(F.sum("__n").alias("__s"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("__c").isNull().alias("last"), (-F.col("__c")).alias("down"), F.col("__s").alias("s"))))
    list_of = cells.agg(ordered.alias("a"))
    before = F.transform("a", lambda x, i: F.struct(
        (-x["down"]).alias("__k"), F.aggregate(F.slice("a", 1, i), F.lit(0).cast("bigint"), lambda t, y: t + y["s"]).alias("__before")))
    starts = list_of.select(F.inline(before))
    above = Window.partitionBy("__c").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("__in", F.coalesce(F.sum("__n").over(above), F.lit(0)))
    ranks = inside.join(starts, inside["__c"].eqNullSafe(starts["__k"])).select(
        F.col(value).alias("__v"), (F.col("__before") + F.col("__in") + 1).alias(out))
    return df.join(ranks, df[value].eqNullSafe(ranks["__v"])).drop("__v")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rk") -> DataFrame:
    """Top ``k`` per group with ties; Catalyst keeps only candidates before the shuffle (WindowGroupLimit)."""
    return rank_in(df, keys, order, out).where(F.col(out) <= k)


def top_share(df: DataFrame, key: str, entity: str, k: int) -> DataFrame:
    """The ``k`` keys with most distinct entities and their share of the sum over all keys."""
    counts = df.select(key, entity).distinct().groupBy(key).agg(F.count(entity).alias("visitors"))
    whole = counts.agg(F.sum("visitors")).scalar()
    top = counts.orderBy(F.col("visitors").desc(), F.col(key)).limit(k)
    return top.withColumn("share", F.try_divide(F.col("visitors").cast("double"), whole))
