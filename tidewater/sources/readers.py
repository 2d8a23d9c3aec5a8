"""Batch and streaming readers. Hosts, users and passwords are always the caller's options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources import event_log


def read_events(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
    path: str | None = None,
    subscribe: Sequence[str] = (),
) -> DataFrame:
    """A stream of events.

    For ``kafka``, and for ``event_log`` under ``path``, the topics of ``subscribe`` form one stream read from the earliest
    offset; the result has the columns ``topic``, ``value`` (text) and ``timestamp``, with tombstones removed. Other formats
    are file streams over ``path``.
    """
    if fmt == event_log.FORMAT:
        raw = event_log.read_log(spark, path, list(subscribe) or None, **(options or {}))
        return decode_value(raw).select("topic", "value", "timestamp")
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest").option("subscribe", ",".join(subscribe))
        raw = reader.options(**(options or {})).load()
        return decode_value(raw).select("topic", "value", "timestamp")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).load(path)


def decode_value(df: DataFrame, column: str = "value") -> DataFrame:
    """Binary values as text; a null value (tombstone) is dropped and never fails the job."""
    return df.where(F.col(column).isNotNull()).withColumn(column, F.col(column).cast("string"))


def read_cdc(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None, path: str | None = None,
             subscribe: Sequence[str] = ()) -> DataFrame:
    """Captured change envelopes, one JSON text per row in ``value``, from Kafka, an event log or text files."""
    if fmt in ("kafka", event_log.FORMAT):
        return read_events(spark, fmt, options, path=path, subscribe=subscribe)
    return read_events(spark, fmt, options, "value string", path)


def parse_json(df: DataFrame, schema: T.StructType | str, column: str = "value") -> DataFrame:
    """Typed columns from JSON text; rows that do not parse come out as nulls."""
    return df.select(F.from_json(column, schema).alias("__j")).select("__j.*")


def scan(df: DataFrame, dt: str | None, column: str = "dt") -> DataFrame:
    """Rows of one day; on a partitioned table only that partition is read. ``yyyyMMdd`` is accepted as well."""
    if dt is None:
        return df
    day = F.to_date(F.lit(dt), "yyyyMMdd") if dt.isdigit() else F.lit(dt).cast("date")
    return df.where(F.col(column) == day)


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None, camel: bool = False
) -> DataFrame:
    """A table over JDBC. Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in
    ``options`` for anything large: without them a single task reads the table."""
    df = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {})).load()
    return df.toDF(*[snake_to_camel(c) for c in df.columns]) if camel else df


def snake_to_camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p.capitalize() for p in rest)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a fixed schema; a bad line keeps its text in ``_corrupt_record``."""
    parsed = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    if "_corrupt_record" not in parsed.fieldNames():
        parsed = parsed.add("_corrupt_record", "string")
    return parse_json(spark.read.text(path), parsed)


# Layout of a device record.
DEVICE_RECORD = """
    log_id string, device struct<brand:string,plat:string,platv:string,softv:string,uname:string,userkey:string,
    device:string>, gis struct<ip:string>, network struct<net:string>, opa string, log_type string, ts double,
    product_id string, order_id string, user_id string, keywords array<string>
"""


def load_device_records(spark: SparkSession, path: str) -> DataFrame:
    """Device records from text files, flattened, one row per valid record."""
    text = spark.read.text(path)
    rows = text.select(F.from_json(F.trim("value"), DEVICE_RECORD).alias("r")).where(F.col("r.log_id").isNotNull())
    return rows.select(
        "r.log_id", "r.device.*", F.col("r.gis.ip").alias("ip"), F.col("r.network.net").alias("net"), "r.opa",
        "r.log_type", "r.ts", "r.product_id", "r.order_id", "r.user_id", "r.keywords")
