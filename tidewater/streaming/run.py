"""Starting queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewater.session import work_dir


def start(
    df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    trigger: Mapping[str, object] | None = None, name: str | None = None,
) -> StreamingQuery:
    """Run a stream into a ``foreachBatch`` sink. The sink must be idempotent by batch id: after a failure the
    last batch is repeated, and the checkpoint makes the result exactly-once."""
    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode(mode)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def run_available(
    spark: SparkSession, df: DataFrame, name: str, mode: str = "append",
    sink: Callable[[DataFrame, int], None] | None = None,
) -> DataFrame | None:
    """Process what the sources hold now and stop.

    Without a sink the rows go to a Parquet table in the shared work folder, which is returned.
    """
    folder = work_dir(spark, name)
    writer = df.writeStream.option("checkpointLocation", f"{folder}/checkpoint").outputMode(mode)
    if sink is None:
        writer = writer.format("parquet").option("path", f"{folder}/rows")
    else:
        writer = writer.foreachBatch(sink)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows") if sink is None else None


def fan_out(
    split: Callable[[DataFrame], Mapping[str, DataFrame]], write: Callable[[str, DataFrame, int], None],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A sink that splits a micro-batch into several outputs. What ``prepare`` makes of the batch, such as parsed rows, is
    kept for all of them; without it the batch itself is."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        kept = (prepare(batch) if prepare else batch).persist()
        try:
            for name, rows in split(kept).items():
                write(name, rows, batch_id)
        finally:
            kept.unpersist()

    return sink
