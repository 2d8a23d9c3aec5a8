"""Hard negatives by the threshold algorithm over sorted lists of every dimension.

A block of candidates keeps, for every dimension, its rows in the order of that component. For an anchor the lists are read
from the end its component's sign prefers, all to the same depth; rows met are scored exactly. What no list has shown yet
scores at most the threshold, the anchor's product with the values at that depth, so a block is left as soon as the
threshold lies strictly below everything that could still count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stored

#: Rows in a block of candidates, rows a task gathers before it works on them, first depth of sorted access and its growth.
BLOCK, GATHERED, DEPTH, GROWTH = 8_192, 1 << 16, 64, 4
#: Components of anchors that are dealt with at once: this bounds what the driver and every task hold of them.
MOST_COMPONENTS = 1 << 21
LAST_ID = np.iinfo(np.int64).max
LONG = np.iinfo(np.int64)
#: (score, vec_id, no vec_id, row)
Hit = tuple[int, int, bool, int]


class Anchors(NamedTuple):
    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    #: Per anchor the windows (least score, highest score), best first.
    windows: list[list[tuple[int, int]]]


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x); whole numbers as floats where every value is exact, else as Python integers."""
    scaled = np.floor(256.0 * vectors)
    return scaled if not scaled.size or np.abs(scaled).max() < 2.0**53 else np.vectorize(int, otypes=[object])(scaled)


def alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type in which every partial sum of an inner product is exact."""
    if object in (a.dtype, b.dtype):
        most = float("inf")
    else:
        most = max(a.shape[1], 1) * (np.abs(a).max(initial=0) + 1) * (np.abs(b).max(initial=0) + 1)
    if most < 2**24:
        return a.astype(np.float32), b.astype(np.float32)
    if most < 2**53:
        return a.astype(np.float64), b.astype(np.float64)
    return tuple(x if x.dtype == object else np.vectorize(int, otypes=[object])(x) for x in (a, b))


def _as_float(whole: float) -> float:
    """The nearest float, beyond all floats an infinity."""
    try:
        return float(whole)
    except OverflowError:
        return float("inf") if whole > 0 else float("-inf")


def _falling(scores: np.ndarray) -> np.ndarray:
    """Numbers that order the scores from high to low; Python integers are ranked, as they need not fit a float."""
    return -scores if scores.dtype != object else -np.searchsorted(np.sort(scores), scores)


class Block:
    """Candidates with their sorted lists."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, no_id: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.no_id, self.labels, self.vectors = rows, ids, no_id, labels, vectors
        self.lists = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.lists, 0)
        n, depth, self.depths = len(rows), DEPTH, []
        while depth < n:
            self.depths.append(depth)
            depth *= GROWTH
        self.depths.append(n)

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """For every anchor, what unseen rows score at most: before any access and after every depth."""
        n = len(self.rows)
        high = self.values[[n - 1, *[n - d for d in self.depths]]].T
        low = self.values[[0, *[d - 1 for d in self.depths]]].T
        zero = anchors * 0
        return np.maximum(anchors, zero) @ high + np.minimum(anchors, zero) @ low

    def search(self, anchor: np.ndarray, thresholds: Sequence, windows: list[tuple[int, int]], k: int,
               held: list[list[Hit]], eligible: np.ndarray | None) -> None:
        """Put into ``held``, per window, the ``k`` best hits of those it holds and of this block."""
        def bound() -> float:
            return min(h[-1][0] if len(h) == k else low for h, (low, _) in zip(held, windows))

        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        n, before, left = len(self.rows), 0, None
        for depth, threshold, after in zip(self.depths, thresholds, thresholds[1:]):
            if threshold < bound():
                return
            if left is None:
                seen = np.zeros(n, bool)
                left = np.ones(n, bool) if eligible is None else eligible.copy()
            seen[self.lists[n - depth:n - before, up]] = True
            seen[self.lists[before:depth, down]] = True
            if depth == n:
                seen[:] = True
            new = np.flatnonzero(seen & left)
            left[new] = False
            before = depth
            if len(new):
                self._keep(new, self.vectors[new] @ anchor, windows, k, held)
            if not left.any():
                return

    def _keep(self, new: np.ndarray, scores: np.ndarray, windows: list[tuple[int, int]], k: int, held: list[list[Hit]]) -> None:
        for w, (low, high) in enumerate(windows):
            least = held[w][-1][0] if len(held[w]) == k else low
            if scores.dtype != object:
                least, high = _as_float(least), _as_float(high)
            some = np.flatnonzero((scores >= least) & (scores <= high))
            if len(some) > k:
                some = some[scores[some] >= np.sort(scores[some])[-k]]
            if len(some) > k:
                at = new[some]
                some = some[np.lexsort((self.rows[at], self.no_id[at], self.ids[at], _falling(scores[some])))[:k]]
            best = [(int(scores[i]), int(self.ids[new[i]]), bool(self.no_id[new[i]]), int(self.rows[new[i]])) for i in some]
            held[w] = sorted(held[w] + best, key=lambda h: (-h[0], *h[1:]))[:k]


def _blocks(batches: Iterator[pa.RecordBatch], by_label: bool) -> Iterator[Block]:
    """Blocks of rows of one length, and of one label where asked for."""
    held: dict[tuple, list[tuple]] = {}
    gathered = 0

    def flush() -> Iterator[Block]:
        for key, rows in held.items():
            for i in range(0, len(rows), BLOCK):
                part = rows[i:i + BLOCK]
                ids = np.array([LAST_ID if r[1] is None else r[1] for r in part], np.int64)
                yield Block(np.array([r[0] for r in part], np.int64), ids, np.array([r[1] is None for r in part]),
                            np.array([r[2] for r in part], np.int64),
                            quantised(np.stack([r[3] for r in part])) if key[0] else np.zeros((len(part), 0)))

    for batch in batches:
        vectors = batch.column(3)
        flat, ends = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64), vectors.offsets.to_numpy()
        for i, (row, vec_id, label) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
            vector = flat[ends[i]:ends[i + 1]]
            held.setdefault((len(vector), label if by_label else None), []).append((row, vec_id, label, vector))
        gathered += batch.num_rows
        if gathered >= GATHERED:
            yield from flush()
            held, gathered = {}, 0
    yield from flush()


def _hits(candidates: DataFrame, anchors: dict[int, Anchors], k: int, same_label: bool) -> DataFrame:
    """anchor (its row), window, score, vec_id, row: the hits of every task, at most ``k`` a window."""
    spark = candidates.sparkSession
    shared = spark.sparkContext.broadcast(anchors)
    schema = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        held = {size: [[[] for _ in w] for w in a.windows] for size, a in given.items()}
        by_label = {size: {x: np.flatnonzero(a.labels == x) for x in np.unique(a.labels)} for size, a in given.items()}
        for block in _blocks(batches, same_label):
            size = block.vectors.shape[1]
            if size not in given:
                continue
            a = given[size]
            chosen = by_label[size].get(block.labels[0], np.zeros(0, int)) if same_label else np.arange(len(a.rows))
            if not len(chosen):
                continue
            anchor_vectors, block.vectors = alike(a.vectors[chosen], block.vectors)
            block.values = block.values.astype(block.vectors.dtype) if block.vectors.dtype != object else np.take_along_axis(
                block.vectors, block.lists, 0)
            others = {} if same_label else {x: block.labels != x for x in by_label[size]}
            own = {int(r): i for i, r in enumerate(block.rows)} if same_label else {}
            thresholds = block.thresholds(anchor_vectors)
            for i, vector, row_thresholds in zip(chosen, anchor_vectors, thresholds.tolist()):
                if not a.windows[i]:
                    continue
                eligible = others.get(a.labels[i])
                if int(a.rows[i]) in own:
                    eligible = np.ones(len(block.rows), bool)
                    eligible[own[int(a.rows[i])]] = False
                block.search(vector, row_thresholds, a.windows[i], k, held[size][i], eligible)
        out = [(int(a.rows[i]), w, min(max(h[0], LONG.min), LONG.max), None if h[2] else h[1], h[3])
               for size, a in given.items() for i, windows in enumerate(held[size]) for w, hits in enumerate(windows) for h in hits]
        for i in range(0, len(out), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[i:i + (1 << 16)]), schema)], schema=schema)

    return candidates.select("row", "vec_id", "label", "embedding").mapInArrow(
        run, "anchor long, window int, score long, vec_id long, row long")


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best hits of a window; a window has at most ``k`` rows a task."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")]
    place = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(*order))
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def _usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * 256) < float("inf"), F.lit(False)))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(
        F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; other columns are not read. Rows with a null label or vector or a null or
    non-finite component (256 times the component included) take no part. Anchors are the rows whose vec_id is divisible by
    ``every``. Their first ``positives`` other rows of the same label are paired with the first ``negatives`` rows of another
    label that score ``low`` to ``high`` per cent of the positive; higher scores first, then smaller vec_id, null last.
    Repeated rows are rows of their own. Only vectors of one length meet. Scores are exact; one beyond a long is returned as
    the nearest long. No anchors give no rows.

    Anchors are a stated share of the table: they go through the driver and to the tasks in blocks of MOST_COMPONENTS
    components, and every block meets all rows. A task keeps ``positives`` times ``negatives`` hits an anchor.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors)
    parts = max(spark.sparkContext.defaultParallelism, usable.count() // (4 * GATHERED) + 1)
    rows = stored(usable.repartition(parts).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    of_anchor: Column = F.col("vec_id") % every == 0
    n, components = rows.where(of_anchor).agg(F.count("*"), F.sum(F.size("embedding"))).first()
    chunks = int((components or 0) + n) // MOST_COMPONENTS + 1
    found = None
    for chunk in range(chunks if n else 0):
        some = rows.where(of_anchor & (F.pmod(F.xxhash64("row"), F.lit(chunks)) == chunk)).collect()
        part = stored(_chunk(rows, some, positives, negatives, low, high), "negatives-found")
        found = part if found is None else found.unionByName(part)
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return found if found is not None else spark.createDataFrame([], empty)


def _chunk(rows: DataFrame, some: list, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    by_size: dict[int, list] = {}
    for r in some:
        by_size.setdefault(len(r.embedding), []).append(r)
    anchors = {size: Anchors(np.array([r.row for r in a], np.int64), np.array([r.label for r in a], np.int64),
                             quantised(np.array([r.embedding for r in a], np.float64).reshape(len(a), size)),
                             [[(float("-inf"), float("inf"))]] * len(a)) for size, a in by_size.items()}
    best = stored(_best(_hits(rows, anchors, positives, True), positives), "negatives-positives")
    scores: dict[int, set[int]] = {}
    for r in best.select("anchor", "score").distinct().collect():
        scores.setdefault(r.anchor, set()).add(r.score)
    windows = {a: [(s, (-(-low * s // 100), high * s // 100)) for s in sorted(found, reverse=True)] for a, found in scores.items()}
    windows = {a: [(s, w) for s, w in found if w[0] <= w[1]] for a, found in windows.items()}
    asked = {size: a._replace(windows=[[w for _, w in windows.get(int(r), [])] for r in a.rows]) for size, a in anchors.items()}
    numbered = [(a, i, s) for a, found in windows.items() for i, (s, _) in enumerate(found)]
    names = rows.sparkSession.createDataFrame([(r.row, r.vec_id) for r in some], "anchor long, anchor_id long")
    of_window = rows.sparkSession.createDataFrame(numbered, "anchor long, window int, score long")
    pairs = best.select("anchor", F.col("vec_id").alias("positive_id"), "score").join(of_window, ["anchor", "score"])
    hits = _best(_hits(rows, asked, negatives, False), negatives).select(
        "anchor", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(hits, ["anchor", "window"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("score").alias("positive_score"),
        "negative_score")
