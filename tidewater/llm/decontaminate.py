"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted similarity.

Column functions and joins only.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import own_names, small, stored, words

SHINGLE = 5
#: Two fingerprints within the radius agree in one of the blocks up to RADIUS // BLOCKS bits. Each shingle counts by the
#: root of its weight: at a weighted similarity of 0.8 the expected distance is then 10 of 64 bits with a deviation of 3.
RADIUS, BLOCKS = 18, 6
#: Up to so many rows of benchmark shingles or of block values are broadcast; beyond it Spark shuffles both sides.
MOST_SHINGLES = 2_000_000
#: Up to so many windows to fingerprint are broadcast to the texts (about 30 bytes each); beyond it Spark shuffles both.
MOST_WINDOWS = 1_000_000
EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]


def with_shingles(df: DataFrame) -> DataFrame:
    """The rows plus ``sh``: the hashes of their word shingles by position, null for a text with fewer words.

    No filter stands on a computed array, here or where it is exploded: Spark would push the filter below the
    projection and compute the array again for each element.
    """
    at = lambda i, k: F.get("hashes", i + k)
    rolled = F.transform(F.sequence(F.lit(0), F.size("hashes") - SHINGLE),
                         lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2), at(i, 3), at(i, 4)))
    return (df.withColumn("hashes", F.transform(words(F.lower("text")), lambda x: F.xxhash64(x)))
            .withColumn("sh", F.when(F.size("hashes") >= SHINGLE, rolled)).drop("hashes"))


def simhash(df: DataFrame, keys: list[str], shingles: str, weights: DataFrame, highest: float, out: str) -> DataFrame:
    """``keys`` (which name a row) and the 64-bit SimHash of each row's distinct shingles as ``out``.

    A shingle counts by the root of its weight, in millionths, so that sums do not depend on their order; one without a weight
    has the highest. Bit b is set when the shingles with it outweigh those without, ties count as not. Rows are exploded and
    summed under their key, so a row of very many shingles needs no more room than others.
    """
    share = F.round(F.sqrt(F.coalesce("weight", F.lit(highest))) * 1_000_000).cast("long")
    each = (df.select(*keys, F.explode(F.array_distinct(shingles)).alias("shingle")).join(weights, "shingle", "left")
            .withColumn("share", share))
    bit = lambda b: F.shiftright("shingle", b).bitwiseAND(F.lit(1))
    sums = each.groupBy(*keys).agg(*[F.sum(F.col("share") * (bit(b) * 2 - 1)).alias(f"bit_{b}") for b in range(64)])
    one = lambda b: F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long")
    value = F.lit(0).cast("long")
    for b in range(64):
        value = value.bitwiseOR(F.when(F.col(f"bit_{b}") > 0, one(b)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, value.alias(out))


def blocks(fingerprint: str, near: bool) -> Column:
    """(block, value) of a fingerprint; ``near`` adds every value within RADIUS // BLOCKS flipped bits."""
    out = []
    for k in range(BLOCKS):
        width = EDGES[k + 1] - EDGES[k]
        masks = [sum(1 << b for b in c) for r in range(RADIUS // BLOCKS + 1 if near else 1) for c in combinations(range(width), r)]
        value = F.shiftrightunsigned(fingerprint, EDGES[k]).bitwiseAND(F.lit((1 << width) - 1))
        out.append(F.transform(F.split(F.lit(",".join(map(str, masks))), ","), _flip(k, value)))
    return F.concat(*out)


def near_values() -> int:
    """Rows that ``blocks`` makes of a fingerprint with ``near``."""
    return sum(comb(EDGES[k + 1] - EDGES[k], r) for k in range(BLOCKS) for r in range(RADIUS // BLOCKS + 1))


def _flip(block: int, value: Column):
    return lambda m: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(m.cast("long")).alias("value"))


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, similarity (of the best window), window_start (word) and n_windows for each leak.

    Windows are as long as an item, cut at the edges of the text: an item may lack its first or last words there, and a
    text may be shorter than the item. Windows that share no shingle with any item have similarity 0 and get no
    fingerprint; every other window that places a shared shingle where an item has it is fingerprinted and looked up by
    its blocks among all items of that length, unless it holds fewer shingles than any such item needs for the threshold
    (its heaviest, counted exactly). Candidates within the radius are verified: shared shingle weight over united weight, a
    shingle weighing ln(1 + items / items with it), the larger for those that few items have.
    Fingerprints weigh shingles as the similarity does, so the radius covers items that share an opening as well.
    Null, empty or short texts and items (fewer than five words) match nothing; repeated rows of a document count as
    one; rows without doc_id are left out; empty tables give no rows.
    """
    bench = stored(with_shingles(benchmark.select("item_id", "text").where("item_id is not null")).dropDuplicates(["item_id"]).select(
        "item_id", "sh").withColumn("length", F.size("sh")), "bench-items").where("sh is not null")
    items = bench.select("item_id", "length", F.posexplode("sh").alias("at", "shingle"))
    n_items, n_shingles = bench.count(), items.count()
    fits = lambda df: small(df, n_shingles, MOST_SHINGLES)
    weights = (items.select("item_id", "shingle").distinct().groupBy("shingle")
               .agg(F.log(F.lit(1.0) + F.lit(float(max(n_items, 1))) / F.count("*")).alias("weight")))
    weights = stored(weights, "bench-weights")
    highest = float(weights.agg(F.max("weight")).collect()[0][0] or 0.0)
    ordered = (items.select("item_id", "shingle").distinct().join(weights, "shingle").groupBy("item_id")
               .agg(F.sort_array(F.collect_list("weight"), False).alias("heaviest"), F.sum("weight").alias("item_weight")))
    needed = ordered.select("item_id", F.aggregate(
        "heaviest", F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda a, w: F.struct((a["sum"] + w).alias("sum"), (a["n"] + F.when(
            a["sum"] < F.col("item_weight") * (threshold - 1e-9), 1).otherwise(0)).alias("n")))["n"].alias("least"))
    places = items.join(needed, "item_id").groupBy("shingle", "at", "length").agg(F.min("least").alias("least"))

    rows = with_shingles(docs.select("doc_id", "text").where("doc_id is not null"))
    start = F.greatest(F.col("pos") - F.col("at"), F.lit(0))
    end = F.least(F.col("pos") - F.col("at") + F.col("length"), F.col("n"))
    hits = (rows.select("doc_id", F.size("sh").alias("n"), F.posexplode_outer("sh").alias("pos", "shingle")).join(fits(places), "shingle")
            .select("doc_id", "length", start.alias("start"), (end - start).alias("span"), "least").where("span >= least")
            .drop("least").distinct())
    hits = stored(hits, "bench-windows")
    wanted = hits.groupBy("doc_id").agg(F.collect_set(F.struct("start", "span", "length")).alias("wanted"))
    found = docs.select("doc_id", "text").join(small(wanted, hits.count(), MOST_WINDOWS), "doc_id").dropDuplicates(["doc_id", "text"])
    cut = (with_shingles(found).select("doc_id", F.explode_outer(F.transform("wanted", lambda x: F.struct(
        x["start"].alias("start"), x["span"].alias("span"), x["length"].alias("length"),
        F.slice("sh", x["start"] + 1, x["span"]).alias("window")))).alias("x")).select("doc_id", "x.*")
        .where(F.size("window") == F.col("span")))
    cut = stored(cut, "bench-cuts")
    window = ["doc_id", "start", "span", "length"]
    prints = stored(simhash(cut, window, "window", fits(weights), highest, "print"), "bench-prints")

    index = simhash(bench, ["item_id", "length"], "sh", fits(weights), highest, "fingerprint")
    index = stored(index, "bench-index").withColumn("key", F.explode(blocks("fingerprint", True)))
    index = small(index, n_items * near_values(), MOST_SHINGLES)
    near = (prints.select(*window, "print", F.explode(blocks("print", False)).alias("key"))
            .join(index, ["length", "key"])
            .where(F.bit_count(F.col("print").bitwiseXOR(F.col("fingerprint"))) <= RADIUS)
            .select(*window, "item_id").distinct())
    return verified(near, cut, bench, weights, highest, fits, threshold)


def verified(near: DataFrame, cut: DataFrame, bench: DataFrame, weights: DataFrame, highest: float, fits,
             threshold: float) -> DataFrame:
    """The candidates whose weighted shingle similarity reaches the threshold, best window per document and item.

    A shingle outside the benchmark weighs as much as one that a single item has.
    """
    own = bench.select("item_id", F.array_distinct("sh").alias("sh"))
    weighed = (own.select("item_id", F.explode("sh").alias("shingle")).join(weights, "shingle")
               .groupBy("item_id").agg(F.sum("weight").alias("item_weight"), F.collect_list(F.struct("shingle", "weight")).alias("sh")))
    pairs = (near.join(cut.select("doc_id", "start", "span", "length", "window"), ["doc_id", "start", "span", "length"])
             .join(fits(weighed), "item_id").withColumn("window", F.array_distinct("window")))
    common = F.filter("sh", lambda x: F.array_contains("window", x["shingle"]))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x["weight"])
    return (pairs.withColumn("common", common).withColumn("both", total("common"))
            .withColumn("similarity", F.col("both") / (F.col("item_weight") + (F.size("window") - F.size("common")) * F.lit(highest)))
            .where(F.col("similarity") >= threshold)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"), F.count("*").alias("n_windows"))
            .select("doc_id", "item_id", F.round("best.similarity", 6).alias("similarity"), (-F.col("best.back")).alias("window_start"), "n_windows"))


@own_names("doc_id", "text")
def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents without a leak. Every row is judged by its own text, whatever its doc_id."""
    keyed = docs.withColumn("leak_key", F.md5(F.col("text").cast("binary")))
    found = leaks(keyed.select(F.col("leak_key").alias("doc_id"), "text"), benchmark, threshold)
    gone = stored(found.select(F.col("doc_id").alias("leak_key")).distinct(), "leak-keys")
    return keyed.join(small(gone, gone.count(), MOST_WINDOWS), "leak_key", "left_anti").select(*docs.columns)
