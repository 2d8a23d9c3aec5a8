"""N-gram Jaccard join by PartEnum signatures, exact verification and connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import own_names, small, stored

U = np.uint64
ODD = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)]
#: A signature needs this many shingles; sparser pieces say too little and are left out (see ``signatures``).
LEAST = 2
#: Pieces for each one that is needed, and cuts of the domain before the prefix.
SPARE, SEEDS = 1.1, 3
#: Up to so many ids of texts to verify, or of sets with copies, are broadcast (16 bytes each); beyond it Spark shuffles.
MOST_CHOSEN = 2_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit over the word."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_set(text: str | None, size: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; A-Z lower-cased. Fewer words than ``size`` make one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not found:
        return np.zeros(0, U)
    if len(found) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), seed=size)], U)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), U, len(found))
    n = len(h) - size + 1
    total = np.zeros(n, U)
    for i in range(size):
        total = mixed(total + h[i:i + n] * ODD[i % 4])
    return np.unique(total)


def bands(per: int, most: int = 1 << 40) -> list[int]:
    """Upper ends of the size bands: sets that can be similar lie in the same or in neighbouring bands."""
    ends = [1]
    while ends[-1] < most:
        ends.append((ends[-1] + 1) * 100 // per)
    return ends


def signatures(s: np.ndarray, ends: list[int], per: int) -> np.ndarray:
    """The PartEnum signatures of one set, for its own size band and as the smaller partner in the next.

    Two linked sets of a band differ in at most ``k`` shingles. The domain is cut into parts of two pieces, more than
    ``k`` pieces in all, and every subset of one piece of a part is a signature: at least one piece holds no difference.
    Pieces below ``LEAST`` shingles are left out. ``own`` bounds what this set and a partner differ in; a set with so
    many sparse pieces that a partner might meet it in these alone signs again under another cut, at last with its prefix
    of shingles (any two linked sets share one); two sets sign alike as often as the less affected one needs, so no link
    is lost.
    """
    n, out = len(s), []
    if not n:
        return np.zeros(0, np.int64)
    first = int(np.searchsorted(ends, n))
    for band in (first, first + 1):
        k = (100 - per) * 2 * ends[band] // (100 + per)
        if k == 0:
            continue
        own = (100 - per) * (n + min(ends[band], n * 100 // per)) // (100 + per)
        pieces = 2 * math.ceil((k + 1) * SPARE / 2)
        for seed in range(SEEDS):
            key = U((band * 8 + seed) * 0x51ED270B27 & 0xFFFFFFFFFFFFFFFF)
            at = (mixed(s + key) % U(pieces)).astype(np.int64)
            count = np.bincount(at, minlength=pieces)
            low, high = (np.bincount(at, weights=x.astype(float), minlength=pieces).astype(U) for x in (s & U(0xFFFFFFFF), s >> U(32)))
            value = low * ODD[0] + mixed(high * ODD[1] + key)
            out.append(mixed(mixed(value) + np.arange(pieces, dtype=U) * ODD[2])[count >= LEAST])
            if int((count < LEAST).sum()) < pieces - own:
                break
        else:
            out.append(mixed(s[:n - (per * n + 99) // 100 + 1] * ODD[3] + U(band)))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def text_key() -> Column:
    """A hash of doc_id and text, also where either is null: rows with an equal key are copies."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def sets_of(docs: DataFrame, size: int, found: str = "", per: int = 0) -> DataFrame:
    """doc_id, key, n and fp (64-bit fingerprint of the set); ``found`` "shingles" or "signatures" adds these, for explode or comparison."""
    ends = bands(per) if found == "signatures" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, keys = batch.column(0), batch.column(1), batch.column(2)
            for first in range(0, len(ids), 256):
                rows = [shingle_set(t.as_py(), size) for t in texts.slice(first, 256)]
                with np.errstate(over="ignore"):
                    prints = [int((mixed(s).sum(dtype=U) + U(len(s)) * ODD[3]).view(np.int64)) for s in rows]
                    lists = [signatures(s, ends, per) if ends else s.view(np.int64) for s in rows] if found else []
                out = {"doc_id": ids.slice(first, 256), "key": keys.slice(first, 256), "n": pa.array([len(s) for s in rows], pa.int64()),
                       "fp": pa.array(prints, pa.int64())}
                if found:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                    values = pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64), pa.int64())
                    out["found"] = pa.ListArray.from_arrays(pa.array(offsets), values)
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("key")).mapInArrow(
        run, "doc_id long, key long, n long, fp long" + (", found array<long>" if found else ""))


def linked(n: str, m: str, apart, per: int):
    """Jaccard of at least per/100, from the sizes and the number of shingles in one set only."""
    return apart * (100 + per) <= (F.col(n) + F.col(m)) * (100 - per)


def firsts_of(sets: DataFrame) -> DataFrame:
    """Per set with shingles (fp): the key of one of its rows, one with doc_id where there is one; c, the rows with that key; k, the keys."""
    keys = sets.where("n > 0").groupBy("fp", "key").agg(F.max(F.col("doc_id").isNull()).alias("bare"), F.count("*").alias("c"))
    firsts = keys.groupBy("fp").agg(F.min(F.struct("bare", "key", "c")).alias("first"), F.count("*").alias("k"))
    return stored(firsts.select("fp", "first.key", "first.c", "k"), "partenum-firsts")


def one_each(docs: DataFrame, sets: DataFrame, firsts: DataFrame) -> DataFrame:
    """doc_id and text of one row of each set with shingles, and rows without any; only rows with copies are looked up or shuffled."""
    other = (sets.where("n > 0").join(firsts.where("k > 1").select("fp", F.col("key").alias("first")), "fp")
             .where("key <> first").select("key").distinct().withColumn("told", F.lit("other")))
    told = stored(firsts.where("c > 1").select("key", F.lit("again").alias("told")).union(other), "partenum-copied")
    rows = docs.withColumn("key", text_key()).join(small(told, told.count(), MOST_CHOSEN), "key", "left")
    return rows.where("told is null").drop("told").union(rows.where("told = 'again'").drop("told").dropDuplicates(["key"]))


def fetched(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id and text of one row for each key of ``chosen`` (key, c); keys of one row need no shuffle of texts."""
    rows = docs.withColumn("key", text_key()).join(small(chosen, chosen.count(), MOST_CHOSEN), "key")
    return rows.where("c = 1").drop("c").union(rows.where("c > 1").drop("c").dropDuplicates(["key"]))


def links(docs: DataFrame, sets: DataFrame, size: int, per: int) -> DataFrame:
    """Verified links (a, b) between fingerprints: enough of them to connect every pair of linked sets.

    In each group of equal signatures the set that meets most others is the hub; the others are compared with it. Sets
    not linked to the hub are then compared with the other sets of its groups, through what they differ in from the hub:
    linked sets must share part of that, so the join runs over a prefix of the differences, those outside the hub first.
    Of its differences a set shares all but ``whole - 1`` with any set linked to it; if it is linked to the hub, and the
    other one is not, at least all but ``half`` as well. Sets that links to hubs connect already are not compared again.
    A pair is a candidate only where a common difference can be the first of enough: ``most`` counts those from it on.
    It is compared under one hub, where the two have the fewest differences: what they differ in is the same under each.
    Signatures are made once for one row of each set and never stored; arrays move only where ids are too many to broadcast.
    Texts to verify are fetched by the key of one row of each set, a row with doc_id where there is one.
    """
    by_signature = Window.partitionBy("sig")
    firsts = firsts_of(sets)
    signed = sets_of(one_each(docs, sets, firsts), size, "signatures", per)
    shared = stored(signed.select(F.explode("found").alias("sig"), "fp").withColumn("low", F.min("fp").over(by_signature))
                    .withColumn("high", F.max("fp").over(by_signature)).withColumn("c", F.count("*").over(by_signature))
                    .where("low <> high").select("sig", "fp", "c").distinct(), "partenum")
    degree = shared.groupBy("fp").agg(F.sum("c").alias("degree"))
    hubs = shared.join(degree, "fp").groupBy("sig").agg(F.max(F.struct("degree", "fp")).alias("hub"))
    pairs = stored(shared.join(hubs.select("sig", F.col("hub.fp").alias("hub")), "sig").where("fp <> hub")
                   .groupBy("hub", "fp").agg((F.max("c") > 2).alias("wide")), "partenum-pairs")
    hubs = stored(pairs.select("hub").distinct(), "partenum-hubs")
    needed = pairs.select("fp").union(hubs).distinct()
    chosen = stored(firsts.join(needed, "fp", "left_semi").select("key", "c"), "partenum-chosen")
    found = stored(sets_of(fetched(docs, chosen), size, "shingles").select("fp", "n", "found"), "partenum-sets")
    of_hubs = found.select(F.col("fp").alias("hub"), F.col("n").alias("hub_n"), F.col("found").alias("hub_set"))
    of_hubs = of_hubs.join(small(hubs, hubs.count(), MOST_CHOSEN), "hub", "left_semi")
    both = (small(pairs, pairs.count(), MOST_CHOSEN).join(of_hubs, "hub").join(found, "fp")
            .withColumn("added", F.array_except("found", "hub_set")).withColumn("gone", F.array_except("hub_set", "found"))
            .select("hub", "fp", "n", "wide", F.when(F.col("wide"), F.col("added")).alias("added"), F.when(F.col("wide"), F.col("gone")).alias("gone"),
                    linked("n", "hub_n", F.size("added") + F.size("gone"), per).alias("near")))
    both = stored(both, "partenum-verified")
    direct = components(both.where("near").select(F.col("hub").alias("a"), F.col("fp").alias("b")))
    direct = stored(direct.select(F.col("id").alias("fp"), "root"), "partenum-direct")
    wide = both.where("wide").join(small(direct, direct.count(), MOST_CHOSEN), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    open_hubs = wide.groupBy("hub").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("hub")
    open_hubs = stored(open_hubs, "partenum-open")
    apart = (wide.join(small(open_hubs, open_hubs.count(), MOST_CHOSEN), "hub", "left_semi")
             .withColumn("diff", F.concat(F.sort_array("added"), F.sort_array("gone"))).withColumn("d", F.size("diff"))
             .select("hub", "fp", "root", "n", "near", "diff", "d"))
    share = (100 - per) / (100 + per)
    half = F.col("d") - F.floor(F.col("d") * ((1 - share) / 2 - 1e-6))
    whole = F.least(F.col("d"), F.floor(F.col("n") * (share * (1 + 100 / per) + 1e-6)) + 1)
    prefix = F.when(F.col("near"), F.least(half, whole)).otherwise(whole).cast("int")
    rows = apart.select("hub", "fp", "root", "n", "near", "d", F.posexplode(F.slice("diff", F.lit(1), prefix)).alias("at", "shingle"))
    named = lambda x, df: df.select("hub", "shingle", "near", F.col("fp").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("root", "n", "d", "at")])
    most = F.least(F.col("d_a") - F.col("at_a"), F.col("d_b") - F.col("at_b"))  # common differences, if this is the first
    more = (named("a", rows.where("not near")).drop("near").join(named("b", rows), ["hub", "shingle"])
            .where("(near or a < b) and root_a <> root_b").where(linked("n_a", "n_b", F.col("d_a") + F.col("d_b") - 2 * most, per))
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * per)
            .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min(F.struct(F.col("d_a") + F.col("d_b"), "hub")).alias("best"))
            .select("best.hub", "a", "b"))
    side = lambda x: apart.select("hub", F.col("fp").alias(x), F.col("n").alias(f"n_{x}"), F.col("diff").alias(f"diff_{x}"))
    more = stored(more, "partenum-more")
    compared = more.count()
    met = small(more.select("hub", "b").distinct(), compared, MOST_CHOSEN)
    more = (small(more, compared, MOST_CHOSEN).join(side("a"), ["hub", "a"])
            .join(side("b").join(met, ["hub", "b"], "left_semi"), ["hub", "b"])
            .where(linked("n_a", "n_b", F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b")), per)))
    return direct.select(F.col("fp").alias("a"), F.col("root").alias("b")).union(more.select("a", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, root (the smallest id of its component) for every id of an edge list (a, b); large-star and small-star rounds.

    Each round is written to the shared folder; a round aggregates before it joins, so a node with very many edges
    sends one row per task.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    while True:
        ways = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = stored(ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                              F.col("m").alias("b")).where("a <> b").distinct()
        before, edges = edges, stored(small, "star")
        if not before.exceptAll(edges).limit(1).count() and not edges.exceptAll(before).limit(1).count():
            return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))


def join(docs: DataFrame, size: int = 4, per: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) for each row of ``docs``.

    Two documents link when 100 * |intersection| >= per * |union| of their shingle sets. Equal sets are one node, so
    copies cost one row each. Null, empty and blank texts have no shingles and stand alone; rows with equal doc_id and
    text give equal rows; a null doc_id never names a component unless all its members lack one; no rows give no rows.
    """
    sets, named = grouped(docs, size, per)
    named = named.select("fp", "component")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return sets.select("doc_id", "n", "fp").join(named, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def grouped(docs: DataFrame, size: int, per: int) -> tuple[DataFrame, DataFrame]:
    """The stored sets of the rows (doc_id, key, n, fp), and fp, root and component of every set with shingles."""
    docs = docs.select("doc_id", "text")
    sets = stored(sets_of(docs, size), "partenum-sizes")
    firsts = sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = links(docs, sets, size, per)
    roots = components(found)
    named = firsts.join(roots, F.col("fp") == F.col("id"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    return sets, named.join(named.groupBy("root").agg(F.min("first").alias("component")), "root").select("fp", "root", "component")


@own_names("doc_id", "text")
def representatives(docs: DataFrame, size: int = 5, per: int = 80) -> DataFrame:
    """The documents with one of each group of near duplicates: a row with the smallest doc_id, null last.

    Rows are told apart by ``text_key``, not by doc_id: texts that share a doc_id or lack one are judged on their own.
    Rows with equal doc_id and text are copies of one document; one of them stays. Rows without shingles are near
    nothing; of those with equal doc_id and text one stays, those without doc_id stay all.
    """
    sets, named = grouped(docs, size, per)
    order = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "key"))
    firsts = sets.where("n > 0").groupBy("fp").agg(order.alias("first")).join(named.select("fp", "root"), "fp")
    chosen = stored(firsts.groupBy("root").agg(F.min("first").alias("first")).select("first.key"), "partenum-kept")
    keys = sets.groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("c"), F.max("doc_id").alias("doc_id"))
    keys = keys.join(chosen.withColumn("stays", F.lit(True)), "key", "left")
    told = F.when((F.col("n") > 0) & F.col("stays").isNull(), "other").when(
        (F.col("c") > 1) & ((F.col("n") > 0) | F.col("doc_id").isNotNull()), "again")
    told = stored(keys.select("key", told.alias("told")).where("told is not null"), "partenum-told")
    rows = (docs.withColumn("key", text_key()).join(small(told, told.count(), MOST_CHOSEN), "key", "left")
            .where("told is null or told <> 'other'"))
    copies = rows.where("told = 'again'").groupBy("key").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return rows.where("told is null").select(*docs.columns).union(copies)
