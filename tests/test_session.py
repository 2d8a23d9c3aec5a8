"""Session settings."""

from tidewater.session import SMALL_TASKS, use_small_tasks

SIZE, PARTS = SMALL_TASKS


def test_tasks_are_small_unless_the_session_says_otherwise(spark):
    try:
        spark.conf.unset(SIZE)
        spark.conf.set(PARTS, "7")
        use_small_tasks(spark)
        assert spark.conf.get(SIZE) == "16m" and spark.conf.get(PARTS) == "7"
        spark.conf.unset(PARTS)
        use_small_tasks(spark)
        rows = spark.range(0, 4_000_000, 1, 4).selectExpr("uuid() as id", "uuid() as x").repartition("id")
        assert rows.groupBy("id").count().count() == 4_000_000
        assert rows.rdd.getNumPartitions() > 4 * 2
    finally:
        spark.conf.unset(PARTS)
