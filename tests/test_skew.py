"""A key that holds most rows: results stay whole, and the work is spread."""

from pyspark.sql import functions as F

from tidewater.operators.rollups import n_day_entities
from tidewater.operators.sequences import latest, sequence_rows
from tidewater.operators.sets import collect_values
from tidewater.streaming import window_stats


def hot(spark, n=20000):
    """Nine of ten rows belong to key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 97).alias("k"), "id", (F.col("id") % 500).alias("u"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"))


def test_windows_of_a_hot_key_are_cut_into_slices(spark):
    df = hot(spark)
    out = sequence_rows(df, ["k"], ["ts"], F.date_trunc("hour", "ts"), next_of={"nxt": "id"}, index="i")
    plan = out._jdf.queryExecution().executedPlan().toString()
    big = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert big and all("__b" in line for line in big)
    stats = out.where("k = 0").agg(F.count("*"), F.max("i"), F.count("nxt")).first()
    n = hot(spark).where("k = 0").count()
    assert tuple(stats) == (n, n, n - 1)


def test_newest_row_needs_no_window(spark):
    out = latest(hot(spark), ["k"], ["ts"])
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("k = 0").first()["id"] == 19998


def test_distinct_users_are_never_collected(spark):
    df = hot(spark)
    out = window_stats(df, "ts", "1 day", ["k"], "u", {"n": F.lit(1)}, {"users": "n"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    want = df.groupBy(F.window("ts", "1 day"), "k").agg(F.count_distinct("u").alias("c")).agg(F.sum("c")).first()[0]
    assert out.agg(F.sum("users")).first()[0] == want


def test_copies_are_dropped_before_an_array_is_built(spark):
    out = collect_values(hot(spark).withColumn("v", F.col("u") % 5), "k", "v", "vs")
    assert out.where("k = 0").first()["vs"] == [0, 1, 2, 3, 4]


def test_entity_windows_on_a_hot_key(spark):
    df = hot(spark).withColumn("dt", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("u") % 30).cast("int")))
    out = n_day_entities(df, "2024-01-30", [1, 30], ["k"], "u", "users", {"n": F.lit(1)})
    got = {r["recent_days"]: (r["users"], r["n"]) for r in out.where("k = 0").collect()}
    want = df.where("k = 0").agg(F.count_distinct("u"), F.count("*")).first()
    assert got[30] == tuple(want)
