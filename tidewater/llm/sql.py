"""DuckDB SQL of the queries that SQL can express over whole tables."""

SQL: dict[str, str] = {
    "op13_hard_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM usable AS a JOIN usable AS b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.other_id AS negative_id, p.positive_score,
  n.score AS negative_score
FROM positives AS p JOIN scored AS n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)
QUALIFY row_number() OVER w <= 3
""",
}
