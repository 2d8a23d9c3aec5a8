"""Hard negatives against brute force over all pairs."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import hard_negatives
from tidewater.llm.queries import llm_queries

SMALL = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    usable = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        usable.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    out = []
    for i, (a, label, v) in enumerate(usable):
        if a is None or a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), b is None, b or 0, b, k == label) for j, (b, k, w) in enumerate(usable)
                  if j != i and len(w) == len(v)]
        scored.sort(key=lambda s: s[:3])
        for positive in [s for s in scored if s[4]][:5]:
            fits = [s for s in scored if not s[4] and 50 * -positive[0] <= 100 * -s[0] <= 95 * -positive[0]][:3]
            out += [(a, positive[3], r + 1, s[3], -positive[0], -s[0]) for r, s in enumerate(fits)]
    return out


def table(spark, rows, path):
    df = spark.createDataFrame(rows, ROWS).withColumn("row", F.lit(1)).withColumn("score", F.lit("x")).withColumn("window", F.lit(2))
    df.repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return llm_queries()["op13_hard_negatives"](spark, str(path))


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(4)
    near = rng.normal(size=(4, 8))
    rows = [(i, [float(np.float32(x)) for x in near[i % 4] + rng.normal(size=8) * 0.3], i % 4) for i in range(300)]
    rows += [(400 + i, [1.0] * 8, i % 2) for i in range(120)] + [(400, [1.0] * 8, 0)] * 2
    rows += [(None, [1.0] * 8, 1), (None, [0.5] * 8, 0), (600, [0.0] * 8, 1), (650, [-1.0] * 8, 1), (700, [], 1), (701, [], 2), (702, [], 1)]
    rows += [(750, None, 1), (751, [1.0, None] * 4, 1), (752, [float("nan")] * 8, 1), (753, [float("inf")] * 8, 2), (754, [1.0] * 8, None)]
    rows += [(800 + i, [float(np.float32(x)) for x in rng.normal(size=3)], i % 3) for i in range(60)]
    return rows


def test_query_against_brute_force(spark, tmp_path, odd_rows):
    got = table(spark, odd_rows, tmp_path).collect()
    want = brute(odd_rows)
    assert Counter(map(tuple, got)) == Counter(want) and len(want) > 50


def test_small_blocks_and_several_chunks(spark, tmp_path, odd_rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "MOST_COMPONENTS", 20)
    got = table(spark, odd_rows, tmp_path).collect()
    assert Counter(map(tuple, got)) == Counter(brute(odd_rows))


def test_huge_components_stay_exact(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = [(50 * (i % 2) + i, [float(np.float32(x)) for x in rng.normal(size=4) * 10.0 ** (2 + i % 2 * 5)], i % 2) for i in range(40)]
    rows += [(500, [3e38, 1.0, 0.0, -1.0], 1), (501, [1.0, 2.0, 3.0, 4.0], 0), (502, [-3e38, 1.0, 0.0, 0.0], 1)]
    long = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    got = Counter(map(tuple, table(spark, rows, tmp_path).collect()))
    assert got == Counter((*r[:4], long(r[4]), long(r[5])) for r in brute(rows))


def test_given_vectors(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = llm_queries()["op13_hard_negatives"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows)) and got


def test_a_block_is_left_early():
    rng = np.random.default_rng(1)
    vectors = np.floor(rng.normal(size=(4_000, 4)) * 50)
    block = hard_negatives.Block(np.arange(4_000), np.arange(4_000), np.zeros(4_000, bool), np.zeros(4_000, int), vectors)
    anchor = np.array([3.0, -1.0, 0.0, 2.0])
    held, calls = [[]], []
    keep = block._keep
    block._keep = lambda new, *rest: (calls.append(len(new)), keep(new, *rest))
    block.search(anchor, block.thresholds(anchor[None])[0].tolist(), [(float("-inf"), float("inf"))], 5, held, None)
    scores = vectors @ anchor
    order = sorted(range(4_000), key=lambda i: (-scores[i], i))[:5]
    assert [(h[0], h[3]) for h in held[0]] == [(scores[i], i) for i in order]
    assert sum(calls) < 4_000


def test_no_rows(spark):
    assert hard_negatives.mine(spark.createDataFrame([], "vec_id long, label long, embedding array<float>")).collect() == []
