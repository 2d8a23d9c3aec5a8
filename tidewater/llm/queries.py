"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    byte_bpe,
    decontaminate,
    hard_negatives,
    html_text,
    jaccard,
    licenses,
    mixing,
    quality_rules,
    repair,
    rule_classifier,
    sharding,
    token_counts,
    transcripts,
)
from tidewater.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    return sharding.assign(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


def op8_rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rule_classifier.score(docs, rule_classifier.train(docs, table(spark, sf_dir, "labels")))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = transcripts.raw_lines(table(spark, sf_dir, "conversations"))
    return transcripts.parse(lines, transcripts.train(lines))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (found.conversations, repair.digests(found.turns)):
        part = part.withColumnRenamed("conv_id", "key")
        every = every.join(part, every["conv_id"].eqNullSafe(part["key"]), "left").drop("key")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(vectors.select("vec_id", moved.alias("label"), "embedding"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_decontaminate, op2_quality_rules, op3_license_scan, op4_source_mix, op5_html_text, op6_ring_shards,
        op7_token_counts, op8_rule_classifier, op9_chat_format, op10_jaccard_join, op11_turn_repair, op12_byte_bpe,
        op13_hard_negatives)}


def llm_sql() -> dict[str, str]:
    from tidewater.llm.sql import SQL

    return SQL
