"""Unions and merges of metric rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


union_streams = union_all


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def metric_merge(frames: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Bring metric sets with the same keys into one row per key; a missing measure stays null.

    This is the full outer join of any number of sets: a key that only the second or third set knows gets exactly
    one row, null keys meet, and there is a single shuffle.
    """
    aggs = [F.sum(m).alias(m) for m in measures]
    both = union_all([f.select(*keys, *[c for c in f.columns if c in measures]) for f in frames])
    return both.groupBy(*keys).agg(*aggs)


merge_streams = metric_merge


def combine_scalars(frames: Sequence[DataFrame]) -> DataFrame:
    """One row from several one-row frames with different columns."""
    both = union_all(frames)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def signed_balance(plus: DataFrame, minus: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Sum of the first set less the second, per key; ``measures`` maps output to input columns."""
    parts = [
        df.select(*keys, *[(F.col(src) * sign).alias(out) for out, src in measures.items()])
        for df, sign in ((plus, 1), (minus, -1))
    ]
    both = union_all(parts)
    aggs = [F.sum(out).alias(out) for out in measures]
    return both.groupBy(*keys).agg(*aggs) if keys else both.agg(*aggs)


def collect_structs(df: DataFrame, key: str, fields: Mapping[str, str | Column], out: str) -> DataFrame:
    """Sorted array of the distinct structs of each key.

    Pairs are made distinct by their own shuffle first, so copies of a hot key are gone before any array is built.
    """
    flat = df.select(key, *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()]).distinct()
    return flat.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def collect_values(df: DataFrame, key: str, value: str | Column, out: str) -> DataFrame:
    flat = df.select(key, (F.col(value) if isinstance(value, str) else value).alias("__v")).distinct()
    return flat.groupBy(key).agg(F.array_sort(F.collect_list("__v")).alias(out))
