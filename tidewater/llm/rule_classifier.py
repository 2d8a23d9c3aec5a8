"""Quality classifier: a sparse rule ensemble. Tree paths become rules, lasso logistic weights choose among them, and the
chosen rules are compiled into one column expression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import GAP, words

FEATURES = ["n_words", "symbols", "upper", "digits", "stops", "word_length", "distinct", "top_run", "lines", "bars", "marks"]
#: Most labelled rows that training takes, those with the smallest hash of doc_id: a bounded sample.
MOST_ROWS = 20_000


def with_features(df: DataFrame) -> DataFrame:
    """The rows plus one double per statistic of the whole text; null and empty texts have 0 everywhere."""
    text = F.coalesce(F.col("text"), F.lit(""))
    share = lambda p: F.length(F.regexp_replace(text, p, "")) / F.greatest(F.length(text), F.lit(1))
    n = F.greatest(F.size("feature_words"), F.lit(1))
    repeats = F.aggregate(F.zip_with("feature_words", F.slice("feature_words", F.lit(2), F.greatest(n - 1, F.lit(0))),
                                     lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda a, x: a + x)
    return (df.withColumn("feature_words", words(F.col("text")))
            .withColumn("feature_values", F.transform(F.array(
                F.log1p(F.size("feature_words")), share(r"[^#*$%&<>]+"), share(r"[^\p{Lu}]+"), share(r"[^0-9]+"), share(r"[^.,;:?]+"),
                F.length(F.regexp_replace(text, GAP, "")) / n, F.size(F.array_distinct("feature_words")) / n, repeats / n,
                (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))) / n, share(r"[^|]+"), share(r"[^!]+")),
                lambda x: x.cast("double")))
            .select(*df.columns, *[F.col("feature_values")[i].alias(f"f_{name}") for i, name in enumerate(FEATURES)]))


def paths(x: np.ndarray, g: np.ndarray, depth: int, least: int, path=()) -> list[tuple]:
    """Conditions (feature, above, cut) of every node of a least-squares tree on ``g``."""
    if depth == 0 or len(g) < 2 * least:
        return []
    best = (1e-9, None, None)
    for j in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 33))):
            up = x[:, j] > cut
            k = int(up.sum())
            if least <= k <= len(g) - least:
                a, b = g[up].sum(), g[~up].sum()
                gain = a * a / k + b * b / (len(g) - k) - (a + b) ** 2 / len(g)
                if gain > best[0]:
                    best = (gain, j, float(cut))
    _, j, cut = best
    if j is None:
        return []
    up, out = x[:, j] > cut, []
    for above, side in ((True, up), (False, ~up)):
        here = (*path, (j, above, cut))
        out += [here, *paths(x[side], g[side], depth - 1, least, here)]
    return out


def holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, cut in rule:
        out &= (x[:, j] > cut) == above
    return out


@dataclass(frozen=True)
class RuleModel:
    base: float
    rules: tuple  # (weight, conditions)

    def score(self) -> Column:
        """Probability of label 1 as a column over the statistics."""
        total = F.lit(self.base)
        for weight, rule in self.rules:
            hit = F.lit(True)
            for j, above, cut in rule:
                c = F.col(f"f_{FEATURES[j]}") > cut
                hit = hit & (c if above else ~c)
            total = total + F.when(hit, weight).otherwise(0.0)
        return F.lit(1.0) / (F.exp(-total) + 1.0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 12, depth: int = 3, penalty: float = 2e-3, most: int = 60) -> RuleModel:
    """Boosted trees give the rules, proximal gradient steps the lasso weights. Without both labels the share is the score."""
    rate = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(rate / (1 - rate)))
    if len(y) < 20 or y.min() == y.max():
        return RuleModel(base, ())
    rng, f, found = np.random.default_rng(7), np.full(len(y), base), {}
    for _ in range(trees):
        pick = rng.random(len(y)) < 0.7
        p = 1 / (1 + np.exp(-f))
        for rule in paths(x[pick], (y - p)[pick], depth, max(5, len(y) // 500)):
            found[tuple(sorted(set(rule)))] = None
        for rule in list(found)[-2 ** (depth + 1):]:
            hit = holds(rule, x)
            if hit.any():
                f[hit] += 0.3 * np.clip((y - p)[hit].mean() * 4, -2, 2) / depth
    rules = list(found)
    h = np.stack([holds(r, x) for r in rules], 1).astype(float)
    spread = h.std(0)
    rules, h, spread = [r for r, s in zip(rules, spread) if s > 0], h[:, spread > 0], spread[spread > 0]
    z, w, b = (h - h.mean(0)) / spread, np.zeros(h.shape[1]), base
    step = 4 / max(np.linalg.norm(z, 2) ** 2 / len(y), 1e-9)
    v, old, t = w.copy(), w.copy(), 1.0
    for _ in range(400):
        r = 1 / (1 + np.exp(-(z @ v + b))) - y
        b -= r.mean() * 2
        w = v - step * (z.T @ r) / len(y)
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, old = w + (last - 1) / t * (w - old), w
    keep = [i for i in np.argsort(-np.abs(w), kind="stable")[:most] if w[i]]
    weights = w / spread
    base = float(b - sum(weights[i] * h[:, i].mean() for i in keep))
    return RuleModel(base, tuple((float(weights[i]), rules[i]) for i in keep))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_ROWS) -> RuleModel:
    """A model from labelled rows that are not held out; rows without doc_id or label are left out."""
    marked = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max(label).alias("label_y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = with_features(docs.select("doc_id", "text").join(marked, "doc_id")).select("label_y", *[f"f_{n}" for n in FEATURES]).toPandas()
    rows = rows.sort_values(list(rows.columns))
    return fit(rows[[f"f_{n}" for n in FEATURES]].to_numpy(float), rows["label_y"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for each row; null texts are scored as empty ones. A null doc_id counts as learnt from."""
    return with_features(docs.select("doc_id", "text")).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= cut).cast("int"))
