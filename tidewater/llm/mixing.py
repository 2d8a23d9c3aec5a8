"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import own_names, small, stored, words

#: The hash is refined this many bits at a time: one histogram over all rows, then only over boundary buckets.
BITS = 16
MOST_SOURCES = 100_000


def targets(sizes: DataFrame, weights=(1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """Target per source. ``sizes`` has source and size; sources by code point (null last) take the weights in turn.

    A target stops at ``most`` times its source's size; what exceeds it is dealt again by weight. That is a water
    level: with sources ordered by limit over weight, the capped ones are a prefix. Sources without words get 0.
    The windows run over one row per source.
    """
    cycle, n = F.array(*[F.lit(w) for w in weights]), len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy("rank", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    long = "decimal(38,0)"
    ranked = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("weight", F.get(cycle, ((F.row_number().over(by_name) - 1) % n).cast("int")))
              .withColumn("limit", (F.col("source_size") * most).cast(long))
              .withColumn("rank", F.col("limit") * 1.0 / F.col("weight"))
              .withColumn("all", (F.sum("source_size").over(every) * F.lit(share)).cast(long))
              .withColumn("left_words", F.col("all") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
              .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("capped", F.col("limit") * F.col("left_weight") <= F.col("left_words") * F.col("weight")))
    rest = F.max(F.when(~F.col("capped"), F.struct("left_weight", "left_words"))).over(every)
    level = F.col("rest.left_words").cast("double") * F.col("weight") / F.col("rest.left_weight")
    return ranked.withColumn("rest", rest).select(
        "source", "source_size", F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(level).alias("target"))


def thresholds(sized: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """Per source the whole passes, the hash below which a document is taken once more, and the budget left at that hash.

    ``sized`` has source, size and point (a hash). Histograms of words over the leading bits are nested: each level
    sums only rows inside the bucket in which the budget runs out, until the bucket is a single hash value.
    """
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    plan = (wanted.withColumn("passes", passes.cast("long"))
            .withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
            .withColumn("prefix", F.lit(0).cast("long")))
    plan = stored(plan, "mix-plan")
    n = plan.count()
    for level in range(1, 64 // BITS + 1):
        bucket = F.shiftright("point", 64 - BITS * level)
        inside = sized if level == 1 else sized.join(
            small(plan.select(F.col("source").alias("of"), "prefix"), n, MOST_SOURCES),
            F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("point", 64 - BITS * (level - 1)) == F.col("prefix")),
            "left_semi")
        upto = Window.partitionBy("of").orderBy("bucket")
        sums = (inside.groupBy(F.col("source").alias("of"), bucket.alias("bucket")).agg(F.sum("size").alias("size"))
                .withColumn("upto", F.sum("size").over(upto)))
        edge = (plan.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("upto") > F.col("budget")), "left")
                .groupBy("source", "source_size", "target", "passes")
                .agg(F.min("budget").alias("budget"), F.min(F.struct("bucket", "upto", "size")).alias("edge")))
        plan = stored(edge.select("source", "source_size", "target", "passes",
                                  (F.col("budget") - F.coalesce(F.col("edge.upto") - F.col("edge.size"), F.lit(0))).alias("budget"),
                                  F.col("edge.bucket").alias("prefix")), "mix-plan")
    return plan.select("source", "source_size", "target", "passes", F.col("prefix").alias("threshold"), "budget")


def point(key: Column, text: Column) -> Column:
    """The hash of a row: rows without a key, or with one key and several texts, have hashes of their own."""
    return F.xxhash64(key.isNull(), key.cast("string"), text)


def on_edge() -> Column:
    return F.coalesce(F.col("point") == F.col("threshold"), F.lit(False))


def counted(edge: DataFrame) -> DataFrame:
    """The rows on the boundary hash of their source, with ``extra``: 1 while the budget left for that hash lasts.

    ``row`` is a written row number with the writing task above bit 33. Sums per task give the words before each task, so
    that only the rows of one task are put in order together.
    """
    salted = edge.withColumn("salt", F.shiftright("row", 33))
    by_salt = Window.partitionBy("of").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = (salted.groupBy("of", "salt").agg(F.sum("size").alias("part"))
            .withColumn("before", F.coalesce(F.sum("part").over(by_salt), F.lit(0)))
            .select(F.col("of").alias("sum_of"), F.col("salt").alias("sum_salt"), "before"))
    inside = Window.partitionBy("of", "salt").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    ordered = salted.withColumn("upto", F.sum("size").over(inside))
    fits = F.col("before") + F.col("upto") <= F.col("budget")
    return (ordered.join(sums, F.col("of").eqNullSafe(F.col("sum_of")) & (F.col("salt") == F.col("sum_salt")))
            .withColumn("extra", F.when(fits, 1).otherwise(0)).select(*edge.columns, "extra"))


def with_extra(rows: DataFrame) -> DataFrame:
    below = F.when(F.col("point") < F.col("threshold"), 1).otherwise(0)
    return rows.where(~on_edge()).withColumn("extra", below)


def mix(docs: DataFrame, weights=(1, 2, 3), share: float = 1.0, most: int = 3, key: str = "doc_id") -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words) for each row.

    Nothing is sorted and no text is shuffled. Null or empty texts have size 0 and take part with 0 words; a null
    source is a source of its own; rows with equal keys and texts are copies that share one hash: on the boundary as many
    of them are taken as the budget holds, so reruns agree. An empty table gives no rows. A source's words stay below its
    target by less than its boundary document.
    """
    sized = stored(docs.select(F.col(key).alias("doc_id"), "source", F.size(words(F.col("text"))).cast("long").alias("size"),
                               point(F.col(key), F.col("text")).alias("point"))
                   .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    plan = thresholds(sized, targets(sized, weights, share, most), most)
    plan = small(plan.withColumnRenamed("source", "of"), plan.count(), MOST_SOURCES)
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return (with_extra(rows).unionByName(counted(rows.where(on_edge())))
            .withColumn("copies", (F.col("passes") + F.col("extra")).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")))


@own_names("doc_id", "text", "source")
def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents with their own columns; a document taken twice is there twice.

    The plan per source is joined to the documents, which need no shuffle for it. Rows on a boundary hash are written
    with a row number first: usually one a source.
    """
    sized = stored(docs.select("source", F.size(words(F.col("text"))).cast("long").alias("size"),
                               point(F.col("doc_id"), F.col("text")).alias("point")), "mix-sizes")
    plan = thresholds(sized, targets(sized, **how), how.get("most", 3))
    plan = small(plan.select(F.col("source").alias("of"), "passes", "threshold", "budget"), plan.count(), MOST_SOURCES)
    rows = (docs.withColumn("point", point(F.col("doc_id"), F.col("text")))
            .join(plan, F.col("source").eqNullSafe(F.col("of"))))
    edge = stored(rows.where(on_edge()).withColumn("size", F.size(words(F.col("text"))).cast("long"))
                  .withColumn("row", F.monotonically_increasing_id()), "mix-edge")
    copies = F.explode(F.array_repeat(F.lit(1), (F.col("passes") + F.col("extra")).cast("int")))
    columns = [*docs.columns, "passes", "extra"]
    return with_extra(rows).select(*columns).unionByName(counted(edge).select(*columns)).withColumn("mix_copy", copies).select(*docs.columns)
