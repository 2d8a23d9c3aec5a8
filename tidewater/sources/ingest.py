"""Ingest of source tables into day partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables loaded in full every day and tables loaded by creation day.
SYNC_TYPES = {
    **dict.fromkeys(
        ["a_template_city_distance", "base_complex", "base_dic", "base_organ", "base_region_info", "employee_info",
         "express_courier", "line_base_info", "line_base_shift", "sorter_info", "truck_driver", "truck_info",
         "truck_model", "truck_team", "user_address", "user_info"], "full"),
    **dict.fromkeys(
        ["express_task_collect", "express_task_delivery", "order_cargo", "order_info", "order_org_bound",
         "order_trace_log", "transport_plan_line_detail", "transport_task", "transport_task_detail",
         "transport_task_process"], "inc"),
}

# Warehouse type for each source type. Dates, times and texts are kept as text at ingest.
TYPE_MAP = {
    "tinyint": "tinyint", "smallint": "smallint", "mediumint": "int", "int": "int", "integer": "int",
    "bigint": "bigint", "float": "float", "double": "double", "decimal": "decimal",
    "date": "string", "datetime": "string", "time": "string", "timestamp": "string", "year": "string",
    "char": "string", "varchar": "string", "tinytext": "string", "text": "string", "mediumtext": "string",
    "longtext": "string", "enum": "string", "set": "string", "json": "string",
    "binary": "binary", "varbinary": "binary", "tinyblob": "binary", "blob": "binary", "mediumblob": "binary",
    "longblob": "binary",
}


def map_type(source_type: str) -> str:
    """Warehouse type of a source column type; the base name has to match exactly, unknown types become text."""
    text = source_type.strip().lower()
    base = text.split("(")[0].split()[0]
    mapped = TYPE_MAP.get(base, "string")
    if mapped == "decimal":
        return "decimal" + (text[text.index("("):text.index(")") + 1].replace(" ", "") if "(" in text else "(10,0)")
    return mapped


def warehouse_schema(columns: Sequence[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {map_type(kind)}" for name, kind in columns))


def ingest_full(df: DataFrame, dt: str, column: str = "dt") -> DataFrame:
    """All rows, stored under the run day."""
    return df.withColumn(column, F.lit(dt).cast("date"))


def ingest_inc(df: DataFrame, ts_col: str, dt: str | None = None, column: str = "dt") -> DataFrame:
    """Rows created on the day, stored under their creation day; without a day, all rows (first load)."""
    dated = df.withColumn(column, F.to_date(F.col(ts_col)))
    return dated if dt is None else dated.where(F.col(column) == F.lit(dt).cast("date"))


def create_table(
    spark: SparkSession, name: str, columns: Sequence[tuple[str, str]], location: str | None = None,
    partition: str = "dt", fmt: str = "parquet",
) -> None:
    """Create the day-partitioned table of a source table if it is missing."""
    fields = ", ".join(f"`{c}` {map_type(kind)}" for c, kind in columns)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}, `{partition}` DATE) USING {fmt} "
        f"PARTITIONED BY (`{partition}`){where}"
    )
