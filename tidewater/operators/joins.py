"""Joins.

No join carries a broadcast hint. Catalyst broadcasts a side whose known size is below
``spark.sql.autoBroadcastJoinThreshold`` and AQE does the same with measured sizes; beyond the threshold the
join shuffles, and AQE splits partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def alive(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted; tables without the flag pass through."""
    return df.where(F.col("is_deleted") == "0") if "is_deleted" in df.columns else df


def attach(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str | Column],
    take: Mapping[str, str | Column],
    how: str = "left",
) -> DataFrame:
    """Add columns of one dimension: ``on`` maps fact columns to dimension keys, ``take`` names the new columns."""
    keys = {f"__k{i}": (left, right) for i, (left, right) in enumerate(on.items())}
    narrow = dim.select(
        *[_col(right).alias(name) for name, (_, right) in keys.items()],
        *[_col(source).alias(out) for out, source in take.items()],
    )
    condition = reduce(lambda a, b: a & b, [fact[left] == narrow[name] for name, (left, _) in keys.items()])
    kept = [fact[c] for c in fact.columns if c not in take]
    return fact.join(narrow, condition, how).select(*kept, *[narrow[out] for out in take])


def flatten_star(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str | Column], Mapping[str, str | Column]]]
) -> DataFrame:
    """Left-join a chain of dimensions, each given as (dimension, keys, columns)."""
    for dim, on, take in dims:
        fact = attach(fact, dim, on, take)
    return fact


def join_fact(lines: DataFrame, header: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Inner join of detail lines with their header."""
    return attach(lines, header, on, take, how="inner")


def decode(df: DataFrame, code: str, dictionary: DataFrame, parent: str | None, out: str) -> DataFrame:
    """Name of a code from the shared dictionary, restricted to one parent group."""
    if parent is not None:
        dictionary = dictionary.where(F.col("parent_code") == parent)
    name = "dic_name" if "dic_name" in dictionary.columns else "name"
    return attach(df, dictionary, {code: F.col("id").cast(df.schema[code].dataType)}, {out: name})


def parent_chain(df: DataFrame, dim: DataFrame, start: str, levels: Sequence[str]) -> DataFrame:
    """Walk up a (id, parent_id, name) hierarchy.

    ``start`` holds the id of the first level; for each entry of ``levels`` the columns ``<level>_id`` and
    ``<level>_name`` are added, every level being the parent of the one before.
    """
    previous = start
    for i, level in enumerate(levels):
        parent = f"__p{i}"
        df = df.withColumn(f"{level}_id", F.col(previous))
        df = attach(df, dim, {f"{level}_id": "id"}, {f"{level}_name": "name", parent: "parent_id"})
        previous = parent
    return df.drop(*[f"__p{i}" for i in range(len(levels))])


def resolve_level(df: DataFrame, organ: DataFrame, region: DataFrame, org_id: str = "org_id") -> DataFrame:
    """City and province of an organisation.

    A level-1 organisation sits in a city, so its region is the city and the parent is the province. Any other
    level sits in a district, so the city is the parent and the province the grandparent.
    """
    df = attach(df, organ, {org_id: "id"}, {"__lvl": "org_level", "__rid": "region_id"})
    df = parent_chain(df, region, "__rid", ["__a", "__b", "__c"])
    first = F.col("__lvl") == 1

    def pick(near: str, far: str, part: str) -> Column:
        known = [F.when(F.col(f"{x}_name").isNotNull(), F.col(f"{x}_{part}")) for x in (near, far)]
        return F.when(first, known[0]).otherwise(known[1])

    named = df.withColumns(
        {
            "city_id": pick("__a", "__b", "id"),
            "city_name": pick("__a", "__b", "name"),
            "province_id": pick("__b", "__c", "id"),
            "province_name": pick("__b", "__c", "name"),
        }
    )
    return named.drop(*[c for c in named.columns if c.startswith("__")])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
