"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import own_names

#: The ring has this many points; virtual nodes sit on points, keys fall on points by 16 bits of their hash.
POINTS = 1 << 16
VIRTUAL = 64


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """Virtual nodes (point, shard) in clockwise order; a point belongs to the first shard that claims it."""
    nodes: dict[int, int] = {}
    for shard in range(shards):
        for v in range(virtual):
            point = int.from_bytes(hashlib.sha256(f"{shard}/{v}".encode()).digest()[:8], "big") % POINTS
            while point in nodes:
                point = (point + 1) % POINTS
            nodes[point] = shard
    return sorted(nodes.items())


def ranges(counts: dict[int, int], nodes: list[tuple[int, int]], shards: int, slack: float = 0.0) -> list[tuple]:
    """(arc, first rank, end rank, shard, first slot): what each arc of the ring gives to which shard.

    A shard takes keys of its own arcs until it is full; the rest of an arc goes on clockwise to the next shard with
    room. Without slack the capacities differ by one row at most and add up to the number of rows.
    """
    total = sum(counts.values())
    base, more = divmod(total, shards)
    room = [int((base + (s < more)) * (1 + slack)) + (slack > 0) for s in range(shards)]
    used = [0] * shards
    out, over = [], []

    def put(arc: int, first: int, n: int, shard: int) -> int:
        n = min(n, room[shard] - used[shard])
        if n > 0:
            out.append((arc, first, first + n, shard, used[shard]))
            used[shard] += n
        return max(n, 0)

    for arc, (_, shard) in enumerate(nodes):
        n = counts.get(arc, 0)
        got = put(arc, 0, n, shard)
        if got < n:
            over.append((arc, got, n - got))
    for arc, first, n in over:
        at = arc
        while n:
            at = (at + 1) % len(nodes)
            got = put(arc, first, n, nodes[at][1])
            first, n = first + got, n - got
    return out


@own_names("doc_id", "text", "text_crc32", "size", "shard", "slot")
def assign(docs: DataFrame, shards: int = 16, slack: float = 0.0, virtual: int = VIRTUAL) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot`` (gapless from 0 in each shard).

    The key is doc_id; a row without one is keyed by its text (or its other columns), and rows with equal keys meet in one arc, which may be
    cut anywhere. Law ``rows``: with slack 0 the counts of two shards differ by one at most, whatever the keys.
    One small table of counts per arc (at most ``shards * virtual`` rows) reaches the driver. Empty input: no rows.
    Names of added columns win over columns of ``docs`` with the same name.
    """
    spark, nodes = docs.sparkSession, ring(shards, virtual)
    places = [p for p, _ in nodes]
    arcs = spark.createDataFrame([(p, bisect.bisect_left(places, p) % len(places)) for p in range(POINTS)],
                                 "ring_point int, ring_arc int")
    other = F.xxhash64(F.lit("text"), "text") if "text" in docs.columns else F.xxhash64(F.lit("row"), *sorted(docs.columns))
    key = F.when(F.col("doc_id").isNull(), other).otherwise(F.xxhash64(F.col("doc_id").cast("string")))
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    keyed = (docs.select(*kept, key.alias("ring_key"))
             .withColumn("ring_point", F.shiftrightunsigned("ring_key", 48).cast("int"))
             .join(F.broadcast(arcs), "ring_point"))
    counts = {r["ring_arc"]: r["count"] for r in keyed.groupBy("ring_arc").count().collect()}
    plan = spark.createDataFrame(ranges(counts, nodes, shards, slack) or [(0, 0, 0, 0, 0)],
                                 "of_arc int, first long, end long, shard int, first_slot long")
    order = Window.partitionBy("ring_arc").orderBy("ring_key", *[c for c in ("doc_id", "text_crc32", "size") if c in kept])
    return (keyed.withColumn("ring_rank", (F.row_number().over(order) - 1).cast("long"))
            .join(F.broadcast(plan), (F.col("ring_arc") == F.col("of_arc")) & (F.col("ring_rank") >= F.col("first"))
                  & (F.col("ring_rank") < F.col("end")))
            .select(*kept, "shard", (F.col("first_slot") + F.col("ring_rank") - F.col("first")).alias("slot")))
