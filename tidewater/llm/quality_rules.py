"""Quality rules: repetition counts and the Jensen-Shannon distance to language references. Column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, own_names, words

#: Common words of the reference languages.
COMMON = {
    "en": "the of and to in is that for it as with on".split(),
    "de": "der die und in den von zu das mit sich des auf".split(),
    "fr": "de la le et les des en un du une que est".split(),
    "es": "de la que el en y a los se del las por".split(),
}
VOCABULARY = sorted({w for ws in COMMON.values() for w in ws})
#: Neighbours in the vocabulary, whose occurrences are counted among themselves.
PARTS = [VOCABULARY[i:i + 7] for i in range(0, len(VOCABULARY), 7)]
LONGEST = max(map(len, VOCABULARY))
#: Character classes. A text is cut down class by class, so most passes see only what is left.
CLASSES = {"lower": r"\p{Ll}++", "space": r"[\x20\x09-\x0D]++", "upper": r"\p{Lu}++", "digit": "[0-9]++", "stop": r"[.,;:?'\-()]++",
           "symbol": r"[#*$%&|<>!@^~_=+{}\[\]\\/]++"}
#: Shorter texts are not judged by a histogram.
MIN_CHARS, MIN_COMMON = 200, 40
MAX_CLASS, MAX_WORD = 0.19, 0.65


def with_counts(docs: DataFrame) -> DataFrame:
    """The rows plus word, symbol, line and repetition counts and both histograms, each as an array of longs.

    Repetition: hashes of 5-word windows; only texts that hold a window twice are sorted, inside their row.
    """
    text, get = F.coalesce(F.col("text"), F.lit("")), F.get
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    df = (docs.withColumn("w", words(F.col("text"))).withColumn("n_words", F.size("w").cast("long"))
          .withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
          .withColumn("windows", F.when(F.size("h") >= 5, F.transform(
              F.sequence(F.lit(0), F.size("h") - 5),
              lambda i: F.xxhash64(get("h", i), get("h", i + 1), get("h", i + 2), get("h", i + 3), get("h", i + 4)))))
          .withColumn("twice", F.size(F.array_distinct("windows")) < F.size("windows"))
          .withColumn("sorted", F.when(F.col("twice"), F.sort_array(F.transform(
              "windows", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))))
          .withColumn("again", F.sort_array(F.transform(F.filter("sorted", lambda x, i: F.coalesce(
              get("sorted", i + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
              (i > 0) & (get("sorted", F.greatest(i - 1, F.lit(0)))["h"] == x["h"]), F.lit(False))), lambda x: x["at"])))
          .withColumn("n_repeat_words", F.when(F.size("again") > 0, F.lit(5) + F.aggregate(
              F.transform("again", lambda x, i: F.when(i > 0, F.least(F.lit(5), x - get("again", F.greatest(i - 1, F.lit(0)))))
                          .otherwise(0)), F.lit(0), lambda a, x: a + x)).otherwise(0).cast("long"))
          .withColumn("lines", lines)
          .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")))
    counted = with_histograms(df.drop("h", "windows", "twice", "sorted", "again", "lines"))
    return (counted.withColumn("word_chars", F.col("n_chars_all") - F.col("class_counts")[1])
            .withColumn("n_symbols", F.length(F.regexp_replace("visible", r"[^#*$%&|<>]+", "")).cast("long")).drop("visible"))


def occurrences(words_: str, word: str) -> Column:
    return F.size(F.filter(words_, lambda x: x == word)).cast("long")


def with_histograms(df: DataFrame) -> DataFrame:
    """The rows plus counts of character classes and common words; ``w`` holds the words and goes.

    Common words are kept part by part first, so that each is looked for only among its neighbours.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    names, steps = list(CLASSES), df.withColumn("rest_0", text)
    for i, pattern in enumerate(CLASSES.values()):
        steps = steps.withColumn(f"rest_{i + 1}", F.regexp_replace(f"rest_{i}", pattern, ""))
    long = [F.length(f"rest_{i}").cast("long") for i in range(len(names) + 1)]
    short = F.transform(F.filter("w", lambda x: F.length(x) <= LONGEST), F.lower)
    counted = (steps.withColumn("class_counts", F.array(*[long[i] - long[i + 1] for i in range(len(names))], long[-1]))
               .withColumn("n_chars_all", long[0]).withColumn("visible", F.col("rest_2"))
               .withColumn("common", F.filter(short, lambda x: x.isin(VOCABULARY))))
    between = lambda low, high: F.filter("common", lambda x: x.between(low, high))
    counted = counted.withColumns({f"common_{i}": between(part[0], part[-1]) for i, part in enumerate(PARTS)})
    return counted.select(*[c for c in df.columns if c != "w"], "class_counts", "n_chars_all", "visible", F.size("common").cast("long").alias("n_common"),
                          F.array(*[occurrences(f"common_{i}", v) for i, part in enumerate(PARTS) for v in part]).alias("word_counts"))


def references(docs: DataFrame, languages=tuple(COMMON)) -> dict[str, dict[str, list[float]]]:
    """Per language the usual share of every bin: the median over all its documents long enough to be judged.

    Medians leave junk documents without influence. One aggregate, one row per language; other languages stay out.
    """
    counted = with_histograms(docs.select("lang", "text", words(F.col("text")).alias("w")).where(F.col("lang").isin(list(languages))))
    bins = [("class_counts", len(CLASSES) + 1, F.col("n_chars_all"), MIN_CHARS),
            ("word_counts", len(VOCABULARY), F.col("n_common"), MIN_COMMON)]
    shares = [F.percentile_approx(F.when(n >= least, F.col(c)[i] / n), 0.5, 1000).alias(f"{c}_{i}")
              for c, m, n, least in bins for i in range(m)]
    out = {}
    for r in counted.groupBy("lang").agg(*shares).collect():
        found = r.asDict()
        out[found["lang"]] = {}
        for c, m, _, _ in bins:
            v = [float(found[f"{c}_{i}"] or 0) for i in range(m)]
            out[found["lang"]][c] = [x / sum(v) for x in v] if sum(v) else []
    return out


def divergence(counts: str, reference: list[float]) -> Column:
    """Jensen-Shannon distance (root of the divergence to base 2) between an array of counts and fixed shares."""
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1)).cast("double")

    def part(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2

    parts = F.zip_with(counts, F.array(*[F.lit(q) for q in reference]), part)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def judge(docs: DataFrame, fit_on: DataFrame | None = None, max_class: float = MAX_CLASS, max_word: float = MAX_WORD) -> DataFrame:
    """The rows plus counts, base_failed, class_distance, word_distance and kept.

    The references come from all documents of ``fit_on`` (default: the rows themselves). The distance is to the nearest
    language; a text below the minimum length has no distance, as has every text when no reference language occurs.
    Null and empty texts have no words and fail the base rules. Rows are judged one by one, so repeats agree.
    """
    counted = with_counts(docs)
    known = references(fit_on if fit_on is not None else docs)
    near = lambda c, n: [divergence(c, r[c]) for r in known.values() if len(r.get(c, [])) == n]
    least = lambda cols: F.least(*cols) if len(cols) > 1 else cols[0] if cols else F.lit(None).cast("double")
    return (counted
            .withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))
            .withColumn("class_distance", F.when(F.col("n_chars_all") >= MIN_CHARS, least(near("class_counts", len(CLASSES) + 1))))
            .withColumn("word_distance", F.when(F.col("n_common") >= MIN_COMMON, least(near("word_counts", len(VOCABULARY)))))
            .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("class_distance") > max_class, F.lit(False))
                        & ~F.coalesce(F.col("word_distance") > max_word, F.lit(False))))


@own_names("doc_id", "text", "lang")
def passed(docs: DataFrame, **how) -> DataFrame:
    """The kept rows with their own columns.

    The row mark keeps Spark from pushing the filter below the projections, where it would compute arrays per element.
    """
    marked = judge(docs, **how).withColumn("row_mark", F.monotonically_increasing_id())
    return marked.where(F.col("kept") & (F.col("row_mark") >= 0)).select(*docs.columns)
