"""Counts of common words against plain counting."""

from collections import Counter

from tidewater.llm import quality_rules


def test_common_words_are_counted_part_by_part(spark):
    assert [v for part in quality_rules.PARTS for v in part] == quality_rules.VOCABULARY and len(quality_rules.PARTS) > 3
    texts = ["The the THE that with\u000bDe la LAS aK İn K the of", "y y Y von das mit sich des auf zz", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for row in quality_rules.with_counts(df).collect():
        found = Counter(w for w in (texts[row.doc_id] or "").lower().replace("\u000b", " ").split(" ") if w in quality_rules.VOCABULARY)
        assert dict(zip(quality_rules.VOCABULARY, row.word_counts)) == {v: found[v] for v in quality_rules.VOCABULARY}
        assert row.n_common == sum(found.values())
