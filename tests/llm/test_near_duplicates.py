"""What the near-duplicate join writes, and what it returns for copies."""

import random
from collections import Counter

import pytest

from tidewater.llm import jaccard


@pytest.fixture
def written(monkeypatch):
    """The names, columns and frames of what the join stores."""
    out, store = [], jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: out.append((name, store(df, name))) or out[-1][1])
    return out


def corpus():
    """Families of texts that differ in some words each, with rows that repeat, lack an id or have no words."""
    rng, rows = random.Random(5), []
    for family in range(4):
        words = [f"w{family}x{i}" for i in range(120)]
        for _ in range(12):
            text = list(words)
            for _ in range(rng.randrange(1, 7)):
                text[rng.randrange(len(text))] = f"r{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(text)))
    return rows + rows[:6] + [(100 + i, rows[i][1]) for i in range(4)] + [(None, rows[9][1]), (None, None), (200, " "), (200, " ")]


@pytest.mark.parametrize("how", ["join", "representatives"])
def test_near_duplicates_store_no_signatures_and_compare_a_pair_once(spark, written, how):
    rows = corpus()
    getattr(jaccard, how)(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).count()
    tables = {}
    for name, df in written:
        tables.setdefault(name, df)
    arrays = {n for n, df in tables.items() if any(t.startswith("array") for _, t in df.dtypes)}
    assert arrays <= {"partenum-sets", "partenum-verified"}
    assert tables["partenum-sets"].count() <= len({t for _, t in rows if t and t.strip()})
    assert tables["partenum-verified"].where("not wide and (added is not null or gone is not null)").count() == 0
    pairs = [tuple(r) for r in tables["partenum-more"].select("a", "b").collect()]
    assert all(a < b for a, b in pairs) and len(pairs) == len(set(pairs))


def test_join_of_copies_agrees_with_all_pairs(spark):
    rows = corpus()
    sets = [set(jaccard.shingle_set(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 85 * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            least[top(i)] = min(least.get(top(i), doc), doc)
    want = Counter((doc, len(s), least[top(i)] if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets)))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, got)) == want
