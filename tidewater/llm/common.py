"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import work_dir

#: Words are runs of anything but space and the control characters 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: it cuts lineage and survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """A broadcast hint for a frame whose counted rows stay within ``most``; beyond it Spark shuffles."""
    return F.broadcast(df) if rows <= most else df


def own_names(*used: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """For steps that return their rows with their own columns: columns other than ``used`` carry generated names inside the step,
    so none can clash with a column that the step makes for itself. Columns that the step adds win over theirs."""

    def wrap(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(step)
        def run(docs: DataFrame, *args, **how) -> DataFrame:
            hidden = {c: f"own_column_{i}" for i, c in enumerate(docs.columns) if c.lower() not in used}
            out = step(docs.withColumnsRenamed(hidden), *args, **how)
            made = {c.lower() for c in out.columns}
            beaten = [h for c, h in hidden.items() if c.lower() in made]
            return out.drop(*beaten).withColumnsRenamed({h: c for c, h in hidden.items() if h not in beaten})

        return run

    return wrap
