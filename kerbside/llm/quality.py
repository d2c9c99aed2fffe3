"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words are compared with the mean histograms of
all documents of its language by the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE, bind, settle, words_of

# The most frequent function words of each language, the bins of its word histogram.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del"),
}
#: The bins of documents of any other language.
OTHER_LANGUAGE = "en"
BINS = 8
CHAR_CLASSES = ("lower", "upper", "digit", "space", "stop", "other_ascii", "other")

#: Documents of fewer words are judged by the base rules alone: their histograms say too little.
MIN_WORDS = 50
MIN_CHARS = 200
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the document, the first one included."""

    def covered(places: Column) -> Column:
        near = F.transform(places, lambda p: F.array(p, p + 1, p + 2))
        return F.size(F.array_distinct(F.flatten(near)))

    def few(windows: Column, twice: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(windows) - 1)
        return covered(F.filter(places, lambda i: F.array_contains(twice, F.get(windows, i))))

    def many(windows: Column) -> Column:
        rows = F.array_sort(F.transform(windows, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))

        def same(rows: Column, i: Column, t: Column) -> Column:
            return F.coalesce(F.get(rows, i)["t"] == t, F.lit(False))

        kept = bind(rows, lambda r: F.filter(r, lambda x, j: same(r, j - 1, x["t"]) | same(r, j + 1, x["t"])))
        return covered(F.transform(kept, lambda x: x["i"]))

    def windows_of(words: Column) -> Column:
        return F.transform(
            F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)),
        )

    def count(windows: Column) -> Column:
        twice = bind(
            F.sort_array(windows), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1)))
        )
        return bind(
            twice,
            lambda d: F.when(F.size(d) == 0, 0).when(F.size(d) <= 64, few(windows, d)).otherwise(many(windows)),
        )

    return bind(bind(words, windows_of), count).cast("long")


def common_counts(words: Column, lang: Column) -> Column:
    """How often each common word of the document's language occurs."""

    def of(name: str) -> Column:
        return F.array(*[F.size(words) - F.size(F.array_remove(words, w)) for w in COMMON_WORDS[name]])

    cases = F
    for name in COMMON_WORDS:
        if name != OTHER_LANGUAGE:
            cases = cases.when(lang == name, of(name))
    return cases.otherwise(of(OTHER_LANGUAGE))


def word_features(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: the id, lang, base counts and both histograms (``chars``, ``common``: arrays of double)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        text.alias("text"),
        words_of(F.col("text")).alias("words"),
        F.regexp_replace(text, f"[a-z{SPACE}]+", "").alias("rest"),
    )
    rows = rows.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    left = F.length("rest")

    def of_rest(cls: str) -> Column:
        return left - F.length(F.regexp_replace("rest", f"[{cls}]+", ""))

    spaces = F.length("text") - F.col("word_chars")
    upper, digit, stop, ascii_ = (of_rest(x) for x in ("A-Z", "0-9", ".,;:'()\"?-", r"\x00-\x7F"))
    return rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        (left - F.length(F.regexp_replace("rest", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        bind(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        bind(F.col("words"), repeated_words).alias("n_repeat_words"),
        F.length("text").alias("n_chars"),
        F.array(
            (F.length("text") - left - spaces), upper, digit, spaces, stop,
            ascii_ - upper - digit - stop, left - ascii_,
        ).alias("chars"),
        common_counts(F.col("words"), F.col("lang")).alias("common"),
    )


def shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda c: c / F.greatest(total, F.lit(1)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Base counts, both distances and the verdict, one row per row of ``docs``.

    ``docs`` needs ``text`` and ``lang``; other columns are ignored. The references are the mean histograms of all
    documents of a language that pass the base rule. Null or empty texts have no words and fail; a null language is a
    language of its own; one without a passing document has no reference and adds no verdict. Repeated rows are
    judged one by one. The distances are null below the length guards.
    """
    rows = settle(word_features(docs, id_column), "features")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        failed.alias("base_failed"),
        shares(F.col("chars"), F.col("n_chars")).alias("chars"),
        F.transform(
            F.concat("common", F.array(F.col("n_words").cast("int") - F.aggregate("common", F.lit(0), lambda a, x: a + x))),
            lambda c: c / F.greatest(F.col("n_words"), F.lit(1)),
        ).alias("common"),
    )

    def mean(name: str, n: int) -> Column:
        return F.array(*[F.avg(F.col(name)[i]) for i in range(n)]).alias(f"ref_{name}")

    means = (
        rows.where(~F.col("base_failed"))
        .groupBy("lang")
        .agg(mean("chars", len(CHAR_CLASSES)), mean("common", BINS + 1))
    )
    judged = rows.join(means, "lang", "left").select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when((F.col("n_chars") >= min_chars) & F.col("ref_chars").isNotNull(), js_distance(F.col("chars"), F.col("ref_chars"))).alias("char_distance"),
        F.when((F.col("n_words") >= min_words) & F.col("ref_chars").isNotNull(), js_distance(F.col("common"), F.col("ref_common"))).alias("word_distance"),
    )
    far = F.coalesce(F.col("char_distance") > max_char_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > max_word_distance, F.lit(False)
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~far)
