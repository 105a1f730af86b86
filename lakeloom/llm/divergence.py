"""Document quality by distribution divergence, in DataFrame functions only.

For every language the whole corpus gives two reference histograms: classes of characters,
and the language's most common words, of any length, against all other words. A document is kept when
the Jensen-Shannon distances of its own histograms from those of its language stay below two
limits. Texts too short for a histogram are not judged by it (the length guards). Before
that, base rules reject very short and very repetitive texts.

Defined results: NULL text counts as the empty text and fails the base rules; NULL languages
are a language of their own; repeated rows are judged alike; an empty table gives an empty
result; other columns are not looked at. Three-word windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import join_bounded, words
from lakeloom.session import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Small letters and spaces are most of a text; the other classes are counted in what is left.
MOST = r"[\p{Ll}\x20]+"
SYMBOLS = r"[#*$%&|<>]+"
CHARACTER_CLASSES = {
    "upper": r"\p{Lu}+",
    "other_letter": r"[\p{L}&&[^\p{Lu}]]+",
    "digit": r"\p{Nd}+",
    "stop": r"[.,;:'\"?!-]+",
    "symbol": SYMBOLS,
}


@dataclass(frozen=True)
class Limits:
    """Parameters of the method."""

    characters: float = 0.26
    common_words: float = 0.365
    min_characters: int = 200
    min_words: int = 50
    #: So many words count as common.
    common_count: int = 24
    #: Languages up to which the references are broadcast (about 2 kB each).
    broadcast_languages: int = 2000


def _letter_words(text: Column) -> Column:
    """Runs of letters, in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of counts over the same bins."""

    def share(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
        return F.transform(F.array(total), lambda t: F.transform(counts, lambda c: F.when(t > 0, c / t).otherwise(0.0)))[0]

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(share(p), share(q), lambda x, y: term(x, (x + y) / 2) + term(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def _repeated_words(windows: Column) -> Column:
    """Words inside three-word windows that occur at least twice, from the windows' hashes."""

    def covered(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]))
            | ((i < F.size(s) - 1) & (s[F.least(i + 1, F.size(s) - 1)]["h"] == x["h"])),
        )
        places = F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
        F.element_at(F.transform(F.array(ordered), covered), 1)
    )


def features(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document: the base counts, the character classes and the words of letters."""
    text = F.col("body")
    rows = docs.select("doc_id", F.col("lang").alias("language"), F.coalesce("text", F.lit("")).alias("body"))
    rows = rows.select(
        "doc_id",
        "language",
        words(text).alias("found"),
        F.length(text).cast("bigint").alias("n_chars"),
        F.length(F.replace(text, F.lit(" "), F.lit(""))).alias("not_space"),
        F.regexp_replace(text, MOST, "").alias("left"),
        F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        _letter_words(text).alias("spoken"),
    )

    def without(pattern: str) -> Column:
        return (F.length("left") - F.length(F.regexp_replace("left", pattern, ""))).cast("bigint")

    gaps = F.col("n_chars") - F.col("not_space") + without(r"[\x09-\x0D]+")
    rows = rows.select(
        "doc_id",
        "language",
        "n_chars",
        "spoken",
        gaps.alias("gaps"),
        (F.col("n_chars") - F.col("not_space")).alias("blanks"),
        F.array(*[without(p) for p in CHARACTER_CLASSES.values()]).alias("some"),
        F.length("left").cast("bigint").alias("n_left"),
        F.size("found").cast("bigint").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.size("found") >= 3,
            F.element_at(
                F.transform(
                    F.array(F.col("found")),
                    lambda f: F.transform(F.sequence(F.lit(0), F.size(f) - 3), lambda i: F.xxhash64(f[i], f[i + 1], f[i + 2])),
                ),
                1,
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    counted = F.aggregate("some", F.lit(0).cast("bigint"), lambda a, b: a + b)
    spaces = F.col("gaps")
    small = F.col("n_chars") - F.col("n_left") - F.col("blanks")
    rest = F.greatest(F.col("n_chars") - counted - spaces - small, F.lit(0))
    return rows.select(
        "doc_id",
        "language",
        "n_chars",
        "spoken",
        "n_words",
        (F.col("n_chars") - F.col("gaps")).alias("word_chars"),
        F.col("some")[list(CHARACTER_CLASSES).index("symbol")].alias("n_symbols"),
        "n_dup_lines",
        _repeated_words(F.col("windows")).cast("bigint").alias("n_repeat_words"),
        F.concat("some", F.array(spaces, small, rest)).alias("classes"),
    )


def common_words(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per language with words, from the features of all documents: ``top`` and ``top_words``, their sum."""
    per_word = rows.select("language", F.explode("spoken").alias("word")).groupBy("language", "word").agg(F.count("*").alias("n"))
    ranked = per_word.withColumn("r", F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "word")))
    return (
        ranked.where(F.col("r") <= limits.common_count)
        .groupBy(F.col("language").alias("l"))
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "word", "n"))).alias("top"), F.sum("n").alias("top_words"))
    )


def references(rows: DataFrame, common: DataFrame) -> DataFrame:
    """One row per language from the features of all documents and its common words.

    ``ref_characters`` are its character classes, ``ref_counts`` the counts of its most common
    words and the count of all other words.
    """
    bins = len(CHARACTER_CLASSES) + 3
    totals = rows.groupBy(F.col("language").alias("of")).agg(
        F.array(*[F.sum(F.col("classes")[i]) for i in range(bins)]).alias("ref_characters"), F.sum("n_words").alias("all_words")
    )
    joined = totals.join(common, F.col("of").eqNullSafe(F.col("l")), "left")
    counts = F.coalesce(F.col("top.n"), F.array().cast("array<bigint>"))
    others = F.greatest(F.col("all_words") - F.coalesce("top_words", F.lit(0)), F.lit(0))
    return joined.select(
        "of",
        "ref_characters",
        F.coalesce(F.col("top.word"), F.array().cast("array<string>")).alias("ref_common"),
        F.array_append(counts, others).alias("ref_counts"),
    )


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per document with the base counts, both distances and the verdict.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, character_distance, word_distance``. Texts are read twice: for the common words, and for all else.
    """
    rows = features(docs, limits)
    common = stage(common_words(rows, limits), "common-words")
    named = common.select("l", F.col("top.word").alias("names"))
    rows = join_bounded(rows, named, F.col("language").eqNullSafe(F.col("l")), limits.broadcast_languages)
    names = F.coalesce("names", F.array().cast("array<string>"))
    own = F.element_at(
        F.transform(
            F.array(F.col("spoken")),
            lambda s: F.transform(names, lambda w: (F.size(s) - F.size(F.array_remove(s, w))).cast("bigint")),
        ),
        1,
    )
    # Words stay where they are counted: what is written has numbers only.
    rows = stage(rows.withColumn("own", own).drop("spoken", "l", "names"), "features")
    known = stage(references(rows, common), "references")
    rows = join_bounded(rows, known, F.col("language").eqNullSafe(F.col("of")), limits.broadcast_languages)
    own_total = F.aggregate("own", F.lit(0).cast("bigint"), lambda a, b: a + b)
    rows = rows.withColumn("own", F.array_append("own", F.greatest(F.col("n_words") - own_total, F.lit(0))))
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)).alias("base_failed"),
        F.when(F.col("n_chars") >= limits.min_characters, _distance(F.col("classes"), F.col("ref_characters"))).alias("character_distance"),
        F.when(F.col("n_words") >= limits.min_words, _distance(F.col("own"), F.col("ref_counts"))).alias("word_distance"),
    )
    near = (F.coalesce("character_distance", F.lit(0.0)) <= limits.characters) & (
        F.coalesce("word_distance", F.lit(0.0)) <= limits.common_words
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "character_distance", "word_distance",
    )
