"""Rows without a time, rows behind the watermark, and inputs that fall silent.

Spark drops the first two inside its windows without a trace, and a join of streams waits for its slowest input. A sorting
sink stands before a windowed job: it deals every row of a micro-batch to its input, to the input's late rows or to its
dirty ones, and gives an input that stays silent a heartbeat, a row that carries nothing but a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import event_ts
from tidewater.operators.sets import union_all
from tidewater.streaming.times import HEARTBEAT


@dataclass(frozen=True)
class Input:
    """An input of a windowed job: its time columns, epochs in milliseconds or seconds, and the delay of its watermark."""

    fields: Sequence[str]
    delay_ms: int
    unit: str = "milliseconds"

    @property
    def scale(self) -> int:
        return 1 if self.unit == "milliseconds" else 1000


def gather(streams: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of several inputs as one stream: ``input`` names the column that holds the row."""
    return union_all([df.select(F.lit(name).alias("input"), F.struct("*").alias(name)) for name, df in streams.items()])


def sorting_sink(
    inputs: Mapping[str, Input], folder: str, write: Callable[[str, DataFrame, int], None], window_ms: int = 0,
    idle_ms: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink over :func:`gather`: hands ``write`` the rows of each input as ``<input>``, ``<input>_late`` and
    ``<input>_dirty``. Every row goes to exactly one of them.

    The watermark is that of a Spark query over these inputs: the greatest time of earlier micro-batches less the delay, the
    least of all inputs. A row is late when its window of ``window_ms`` has ended by then, or, with 0 as before an interval
    join, when its own time has. Dirty rows have no time. What is left is never late for a query that reads the rows of
    ``<input>`` batch by batch.

    With ``idle_ms`` an input without a dated row in a micro-batch, and further than that behind the input that is ahead, gets a
    heartbeat at that distance; its column ``heartbeat`` is null in all other rows, and ``with_event_time`` takes
    heartbeats into the watermark and drops them. Rows that the input brings later and behind it are late.

    The greatest times are kept under ``folder`` by batch, one row an input. ``write`` must be idempotent by name and batch id;
    a repeated micro-batch is judged by the same times as before. A new stream needs a folder of its own.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _highs(spark, folder, batch_id - 1)
        at = F.coalesce(*[F.when(F.col("input") == n, event_ts(*[F.col(f"`{n}`.`{f}`") for f in i.fields]) * i.scale)
                          for n, i in inputs.items()])
        timed = batch.withColumn("at", at).persist()
        try:
            now = {r["input"]: r["high"] for r in timed.groupBy("input").agg(F.max("at").alias("high")).collect()}
            after = {n: max((h for h in (before.get(n), now.get(n)) if h is not None), default=None) for n in inputs}
            known = [before.get(n) for n in inputs]
            mark = None if None in known else min(h - i.delay_ms for h, i in zip(known, inputs.values()))
            ends = (F.floor(F.col("at") / window_ms) + 1) * window_ms if window_ms else F.col("at")
            late = F.lit(False) if mark is None else F.coalesce(ends <= mark, F.lit(False))
            lead = max((h for h in after.values() if h is not None), default=None)
            for name, one in inputs.items():
                rows = timed.where(F.col("input") == name)
                fine = rows.where(F.col("at").isNotNull() & ~late).select(f"{name}.*")
                if idle_ms is not None:
                    fine = fine.withColumn(HEARTBEAT, F.lit(None).cast("bigint"))
                    beat = None if lead is None else (lead - idle_ms) // one.scale * one.scale
                    if now.get(name) is None and beat is not None and (after[name] is None or after[name] < beat):
                        after[name] = beat
                        fine = fine.unionByName(_heartbeat(fine, one, beat))
                write(name, fine, batch_id)
                write(f"{name}_late", rows.where(late).select(f"{name}.*"), batch_id)
                write(f"{name}_dirty", rows.where(F.col("at").isNull()).select(f"{name}.*"), batch_id)
            spark.createDataFrame(list(after.items()), "input string, high bigint").coalesce(1).write.mode("overwrite").parquet(
                f"{folder}/batch={batch_id}")
        finally:
            timed.unpersist()

    return sink


def _heartbeat(rows: DataFrame, one: Input, beat: int) -> DataFrame:
    values = {one.fields[0]: F.lit(beat // one.scale), HEARTBEAT: F.lit(beat)}
    return rows.sparkSession.range(1).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])


def _highs(spark: SparkSession, folder: str, batch_id: int) -> dict[str, int]:
    if batch_id < 0:
        return {}
    stored = spark.read.schema("input string, high bigint").parquet(f"{folder}/batch={batch_id}")
    return {r["input"]: r["high"] for r in stored.collect()}
