"""Transaction facts and accumulating snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dims import OPEN_END
from tidewater.operators.joins import attach, decode


def transaction_fact(
    lines: DataFrame,
    header: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    event_time: Column,
    event_name: str,
    codes: Sequence[tuple[str, str]] = (),
    dictionary: DataFrame | None = None,
    predicate: Column | None = None,
) -> DataFrame:
    """Detail lines with their header for the headers that reached an event.

    ``predicate`` is applied to the header before the join. The event time becomes ``event_name`` and its day
    ``dt``. ``codes`` lists (code column, name column) pairs looked up in ``dictionary``.
    """
    if predicate is not None:
        header = header.where(predicate)
    fact = attach(lines, header, on, {c: c for c in take}, how="inner")
    for code, name in codes:
        fact = decode(fact, code, dictionary, None, name)
    fact = fact.withColumn(event_name, event_time)
    return fact.withColumn("dt", F.to_date(F.col(event_name)))


def accumulating_snapshot(
    header: DataFrame, key: str, milestones: Sequence[tuple[DataFrame, str, Mapping[str, str]]]
) -> DataFrame:
    """Header with one left join per milestone, each given as (events, key, columns to take)."""
    for events, event_key, take in milestones:
        header = attach(header, events, {key: event_key}, take)
    return header


def close_interval(closed: Column, closing_day: Column) -> Column:
    """End day of an open process: the closing day once it is closed, else far in the future."""
    return F.when(closed, closing_day.cast("date")).otherwise(F.lit(OPEN_END).cast("date"))


def first_reach(log: DataFrame, key: str, at: str, reached: Mapping[str, Column], closing: Sequence[str], opened: str) -> DataFrame:
    """Per key the least ``opened`` and the first time it reached each event, from a log of its changes; one aggregate.

    What the log says after the first of the ``closing`` events does not count.
    """
    first = log.groupBy(key).agg(F.min(opened).alias(opened), *[F.min(F.when(c, F.col(at))).alias(e) for e, c in reached.items()])
    return _until_closed(first, list(reached), closing)


def merge_reach(before: DataFrame, new: DataFrame, key: str, opened: str, events: Sequence[str], closing: Sequence[str],
                since: str) -> DataFrame:
    """The state of every key after a run from ``since`` on: known events stay, open keys take new ones.

    A key without state that was opened before ``since`` has been closed and stored away; what is new of it is left out.
    """
    both = before.select(key, opened, *events, F.lit(True).alias("__old")).unionByName(
        new.select(key, opened, *events, F.lit(False).alias("__old")))
    known = F.col("__old")
    was_closed = F.coalesce(*[F.col(c) for c in closing]).isNotNull() & known
    merged = both.groupBy(key).agg(
        F.min(opened).alias(opened), F.max(known).alias("__known"), F.max(was_closed).alias("__closed"),
        *[F.min(F.when(known, F.col(e))).alias(f"__was_{e}") for e in events],
        *[F.min(F.when(~known, F.col(e))).alias(f"__now_{e}") for e in events])
    merged = merged.where(F.col("__known") | (F.col(opened) >= F.lit(since).cast("date")))
    merged = merged.select(key, opened, *[
        F.coalesce(f"__was_{e}", F.when(~F.col("__closed"), F.col(f"__now_{e}"))).alias(e) for e in events])
    return _until_closed(merged, events, closing)


def reach_before(rows: DataFrame, events: Sequence[str], opened: str, first: str) -> DataFrame:
    """A state of first times as it stood on the eve of ``first``."""
    day = F.lit(first).cast("date")
    return rows.where(F.col(opened) < day).withColumns({e: F.when(F.to_date(e) < day, F.col(e)) for e in events})


def _until_closed(first: DataFrame, events: Sequence[str], closing: Sequence[str]) -> DataFrame:
    end = F.least(*[F.col(c) for c in closing]) if len(closing) > 1 else F.col(closing[0])
    return first.withColumn("__end", end).withColumns(
        {e: F.when(F.col("__end").isNull() | (F.col(e) <= F.col("__end")), F.col(e)) for e in events}).drop("__end")
