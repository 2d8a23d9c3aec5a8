"""A corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and all rows its predecessor kept; all but the last return the columns of
``documents``. ``run`` writes each stage as Parquet to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontaminate, jaccard, mixing, quality_rules, sharding
from tidewater.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the references come from the rows of this stage."""
    return quality_rules.passed(docs)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8 or more."""
    return jaccard.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document taken several times is there several times."""
    return mixing.apply_mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the shard and slot they go to."""
    return sharding.assign(docs)


STAGES = [("quality", quality_stage), ("duplicates", duplicates_stage), ("decontamination", decontamination_stage),
          ("mixing", mixing_stage), ("sharding", sharding_stage)]

#: Near duplicates and decontamination go beyond SQL over whole tables; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
