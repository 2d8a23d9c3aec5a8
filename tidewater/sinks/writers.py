"""Writers for tables, topics and databases."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions import fmt_day, is_blank
from tidewater.session import work_dir


def overwrite_partition(df: DataFrame, path: str, dt: str | None = None, fmt: str = "parquet") -> None:
    """Replace the day partitions that ``df`` holds, or exactly the one day given, also by no rows; other days stay.

    Rows are clustered by day before writing, with AQE splitting a large day over several tasks, so a task does
    not open a file for every day.
    """
    if dt is not None:
        df.drop("dt").write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/dt={dt}")
        return
    df.hint("rebalance", "dt").write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("dt").save(path)


def overwrite_intervals(spark: SparkSession, df: DataFrame, path: str, first: str, open_end: str) -> None:
    """Write an interval table, partitioned by the day that closed a row: the days from ``first`` on and the open rows;
    earlier days stay.

    ``df`` may come from the table itself and is staged first. Closed days are written before the open rows: a run that
    dies in between loses nothing, since the versions it closed are still open, and repeating it puts both right.
    """
    stage = work_dir(spark, "intervals")
    df.write.parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    closed = F.col("dt") != F.lit(open_end).cast("date")
    try:
        known = spark.read.schema(df.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        known = staged.limit(0)
    touched = closed & (F.col("dt") >= F.lit(first).cast("date"))
    emptied = known.where(touched).select("dt").distinct().subtract(staged.where(closed).select("dt").distinct())
    for row in emptied.toLocalIterator():
        overwrite_partition(staged.limit(0), path, str(row.dt))
    overwrite_partition(staged.where(closed), path)
    overwrite_partition(staged.where(~closed), path, open_end)


def append_partition(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows. Repeating the job repeats the rows; prefer :func:`overwrite_partition`."""
    df.write.format(fmt).mode("append").partitionBy("dt").save(path)


def merge_history(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """Add a run to a report's history and return the whole history.

    Only the partitions of the days in ``new`` are replaced, so the table is never overwritten while it is read
    and repeating a run changes nothing.
    """
    overwrite_partition(new.distinct(), path)
    return spark.read.parquet(path)


def write_events(
    df: DataFrame, fmt: str = "kafka", options: Mapping[str, str] | None = None, topic: str | None = None,
    checkpoint: str | None = None, trigger: Mapping[str, object] | None = None,
) -> StreamingQuery | None:
    """Send rows as JSON to one topic, or keep the ``topic`` column of the rows.

    Kafka gets acks from all replicas and an idempotent producer. A batch frame is written at once, a stream is
    started with its checkpoint.
    """
    payload = [c for c in df.columns if c != "topic"]
    value = F.col("value") if payload == ["value"] else F.to_json(F.struct(*payload))
    target = F.lit(topic) if topic is not None else F.col("topic")
    out = df.select(target.alias("topic"), value.alias("value"))
    settings = dict(options or {})
    if fmt == "kafka":
        settings = {"kafka.acks": "all", "kafka.enable.idempotence": "true", **settings}
    if not df.isStreaming:
        writer = out.write.format(fmt).mode("append").options(**settings)
        (writer if fmt == "kafka" else writer.partitionBy("topic")).save()
        return None
    writer = out.writeStream.format(fmt).options(**settings).option("checkpointLocation", checkpoint)
    if fmt != "kafka":
        writer = writer.partitionBy("topic")
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def route_to_topics(df: DataFrame, topic: Column, **kwargs) -> StreamingQuery | None:
    """Each row goes to the topic its own column expression names."""
    return write_events(df.withColumn("topic", topic), **kwargs)


def write_jdbc(
    df: DataFrame, url: str, table: str, batch: int = 200, options: Mapping[str, str] | None = None,
    max_connections: int = 16,
) -> None:
    """Append rows over JDBC in batches. ``max_connections`` bounds the tasks that write at once;
    the rows are dealt out for it, so the stage before keeps its own number of tasks."""
    df.repartition(max_connections).write.format("jdbc").mode("append").option("url", url).option("dbtable", table) \
        .option("batchsize", batch).options(**(options or {})).save()


def write_day_buckets(df: DataFrame, ts_col: str, path: str, fmt: str = "json") -> DataFrame:
    """Write rows under ``day=yyyyMMdd``; epoch seconds and milliseconds are both accepted and rows without a
    usable time go to ``error_bucket``. Returns the rows with their day."""
    number = F.col(ts_col).try_cast("bigint")
    dated = df.withColumn("day", F.coalesce(fmt_day(number), F.lit("error_bucket")))
    dated.hint("rebalance", "day").write.format(fmt).mode("append").partitionBy("day").save(path)
    return dated


def apply_dim_config(spark: SparkSession, changes: DataFrame, schema_of: Callable[[str], str], database: str) -> list[str]:
    """Create or drop the target tables named by configuration changes.

    ``changes`` holds ``op``, ``before_table`` and ``after_table``, and ``ts_ms`` where changes of one table may follow
    each other: the newest one counts, a drop before a create of the same time. c and r create, d drops, u creates
    the new name. The configuration has one row per dimension table, so its few distinct actions are
    taken on the driver. Returns the statements that ran.
    """
    drop = (F.col("op") == "d") & ~is_blank(F.col("before_table"))
    action = F.when(drop, F.struct(F.lit("drop").alias("kind"), F.col("before_table").alias("name"))).when(
        F.col("op").isin("c", "r", "u") & ~is_blank(F.col("after_table")),
        F.struct(F.lit("create").alias("kind"), F.col("after_table").alias("name")))
    when = F.col("ts_ms") if "ts_ms" in changes.columns else F.lit(0)
    todo = (changes.select(action.alias("a"), when.alias("at")).where("a is not null").groupBy("a.name")
            .agg(F.max(F.struct("at", (F.col("a.kind") == "create").alias("create"), "a.kind")).alias("last"))
            .select("name", "last.kind"))
    ran = []
    for row in todo.orderBy(F.col("kind").desc(), "name").toLocalIterator():
        target = f"{database}.{row['name']}"
        if row["kind"] == "drop":
            statement = f"DROP TABLE IF EXISTS {target}"
        else:
            statement = f"CREATE TABLE IF NOT EXISTS {target} ({schema_of(row['name'])}) USING parquet"
        spark.sql(statement)
        ran.append(statement)
    return ran
