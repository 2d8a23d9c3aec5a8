"""The given tables and helpers to derive columns from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import use_small_tasks, use_utc

ORDER_DAY = "2001-07-01"
EVENT_DAY = "2024-01-30"


# Layout of the given tables, so that no job has to look it up in the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        use_utc(spark)
        use_small_tasks(spark)
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def event_rows(self) -> DataFrame:
        """Events with the number in ``props`` as ``k`` and their day."""
        return events_with_k(self.events)

    def stream(self, name: str) -> DataFrame:
        """A table as a file stream. The file source wants a pattern or a folder, so one letter is a pattern."""
        return self.spark.readStream.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/[{name[0]}]{name[1:]}.parquet")


def events_with_k(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.to_date("ts").alias("dt"))


def tag(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def later(ts: str, days: Column | int = 0, seconds: Column | int = 0) -> Column:
    """A timestamp moved by days and seconds, in whole microseconds."""
    to_col = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("bigint")
    moved = (to_col(days) * 86_400 + to_col(seconds)) * 1_000_000
    return F.timestamp_micros(F.unix_micros(F.col(ts).cast("timestamp")) + moved)
