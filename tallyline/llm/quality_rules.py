"""Quality rules: word, symbol and repetition counts, then distribution divergence.

A document's histogram of character classes and its histogram of common words are compared with those
of its language by Jensen-Shannon distance. A language's reference is the mean histogram over all its
documents that pass the count rules; documents without a known language are held against the mean of
all. Documents under the minimum lengths are not judged by divergence.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import BLANKS, whole, words_of
from tallyline.session import materialize

SYMBOLS = "#*$%&|<>"
BROADCAST_ROWS = 1_000_000  # rejected rows (32 bytes each) up to which they are sent to every task

# The ten most frequent words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it",
    "fr": "de la le et les des en un une du",
    "de": "der die und in den von zu das mit sich",
    "es": "de la que el en y a los del se",
}


@dataclass(frozen=True)
class Limits:
    """Jensen-Shannon distances (0 to 1, base 2) beyond which a document goes, and the least words
    and characters in words from which each histogram says something.

    A text without any common word is only as far from the reference as that has common words, so the
    limit of words is ``word_share`` of this distance, ``word_distance`` at most. References with so few
    common words that it would be under ``word_floor`` don't tell such texts apart."""

    char_distance: float = 0.26
    word_distance: float = 0.30
    word_share: float = 0.9
    word_floor: float = 0.20
    char_least: int = 200
    word_least: int = 50


def _count(text: Column, but: str) -> Column:
    """Characters left when every run of others is taken out."""
    return F.length(F.regexp_replace(text, f"[^{but}]+", "")).cast("long")


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of each 3-word window, in text order."""
    return F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def places_of(windows: Column, twice: Column) -> Column:
    """Where the windows of ``twice`` stand. A few are looked up one by one; for many, windows are
    sorted with their places, so that equal ones are neighbours. Both ways find all."""
    few = F.transform(windows, lambda h, i: F.when(F.array_contains(twice, h), i))
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    runs = F.zip_with(F.slice(placed, 1, F.size(placed) - 1), F.slice(placed, 2, F.size(placed) - 1), lambda x, y: F.when(
        x["h"] == y["h"], F.array(x["i"], y["i"])
    ))
    many = F.array_distinct(F.flatten(F.filter(runs, lambda pair: pair.isNotNull())))
    return F.when(F.size(twice) <= 32, F.filter(few, lambda i: i.isNotNull())).when(twice.isNotNull(), many)


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns plus counts and histograms of each row's whole text (null: empty)."""
    text = F.col("_text")
    step = docs.select(*keep, whole("text").alias("_text"), F.col("lang").alias("_lang"))
    step = step.withColumns({
        "_words": words_of(text),
        "_lines": F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    words, lines = F.col("_words"), F.col("_lines")
    step = step.withColumns({
        "_windows": window_hashes(words),
        "_joined": F.array_join(words, "\n"),
        "_hits": common_hits(words, F.col("_lang")),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    })
    windows = F.col("_windows")
    step = step.withColumn(
        "_hashes", F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(windows))
    )
    hashes = F.col("_hashes")
    step = step.withColumn(
        "_twice", F.array_distinct(F.filter(hashes, lambda h, k: h == F.get(hashes, k - 1)))
    )
    step = step.withColumn("_places", places_of(windows, F.col("_twice")))
    places = F.col("_places")
    covered = F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))
    joined = F.col("_joined")
    step = step.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": (F.length(joined) - F.greatest(F.size(words) - 1, F.lit(0))).cast("long"),
        "n_symbols": _count(text, SYMBOLS),
        "n_repeat_words": F.when(places.isNotNull(), covered).otherwise(0).cast("long"),
        "_upper": _count(text, r"\p{Lu}"),
        "_digits": _count(text, "0-9"),
        "_points": _count(text, ".,;:!?'\"()-"),
        "_marks": _count(text, r"\p{P}\p{S}"),
        "_common": common_counts(F.col("_hits"), F.size(words), F.col("_lang")),
    })
    step = step.withColumn(
        "_chars",
        F.array(
            F.col("word_chars") - F.col("_upper") - F.col("_digits") - F.col("_marks"),
            F.col("_upper"), F.col("_digits"), F.col("_points"), F.col("_marks") - F.col("_points"),
        ),
    )
    return step.select(
        *keep, "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        shares("_chars").alias("_chars"), shares("_common").alias("_common"),
        base_failed().alias("base_failed"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def by_language(lang: Column, of: Callable[[list[str]], Column]) -> Column:
    """``of`` the common words of the row's language; null for languages without a list."""
    cases = [(lang == name, of(listed.split())) for name, listed in COMMON_WORDS.items()]
    return reduce(lambda found, case: found.when(*case), cases[1:], F.when(*cases[0]))


def common_hits(words: Column, lang: Column) -> Column:
    """The words that are, as they stand, common words of the row's language, in text order."""
    return by_language(lang, lambda listed: F.filter(words, lambda w: w.isin(listed)))


def common_counts(hits: Column, n_words: Column, lang: Column) -> Column:
    """Occurrences of each common word, then of all other words."""

    def of(listed: list[str]) -> Column:
        counts = [F.size(F.filter(hits, F.lit(k).__eq__)) for k in listed]
        return F.array(*counts, F.greatest(n_words - F.size(hits), F.lit(0))).cast("array<bigint>")

    return by_language(lang, of)


def shares(counts: str) -> Column:
    """Counts as shares of their sum; null where there is nothing."""
    total = F.aggregate(F.col(counts), F.lit(0).cast("long"), lambda a, x: a + F.greatest(x, F.lit(0)))
    return F.when(total > 0, F.transform(F.col(counts), lambda x: F.greatest(x, F.lit(0)) / total))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares, base 2."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def references(features: DataFrame, limits: Limits) -> DataFrame:
    """Per language (null: all together) the mean histograms of the documents that pass the counts: at
    most one row per listed language and one more."""
    good = features.where(~F.col("base_failed") & (F.col("word_chars") >= limits.char_least))
    listed = F.when(F.col("_lang").isin(list(COMMON_WORDS)), F.col("_lang"))
    n_chars, n_words = 5, len(next(iter(COMMON_WORDS.values())).split()) + 1

    def mean(name: str, n: int) -> Column:
        return F.array(*[F.avg(F.col(name)[i]) for i in range(n)]).alias(f"_ref{name}")

    each = good.where(listed.isNotNull()).groupBy(listed.alias("_of"))
    every = good.agg(mean("_chars", n_chars)).select(
        F.lit("").alias("_of"), "_ref_chars", F.lit(None).cast("array<double>").alias("_ref_common")
    )
    return each.agg(mean("_chars", n_chars), mean("_common", n_words)).unionByName(every)


def word_limit(reference: Column, limits: Limits) -> Column:
    """The distance of common words beyond which a document of this reference goes."""
    without = F.transform(reference, lambda x, i: F.when(i == F.size(reference) - 1, 1.0).otherwise(0.0))
    inside = F.greatest(limits.word_share * distance(without, reference), F.lit(limits.word_floor))
    return F.least(inside, F.lit(limits.word_distance))


def judged(features: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Features plus ``char_distance, word_distance`` (null: not judged) and ``kept``."""
    refs = references(features, limits).withColumn(  # at most len(COMMON_WORDS) + 1 rows
        "_word_limit", word_limit(F.col("_ref_common"), limits)
    )
    of = F.when(F.col("_lang").isin(list(COMMON_WORDS)), F.col("_lang")).otherwise(F.lit(""))
    both = features.withColumn("_of", of).join(F.broadcast(refs), "_of", "left")
    both = both.withColumns({
        "char_distance": F.when(
            F.col("word_chars") >= limits.char_least, distance(F.col("_chars"), F.col("_ref_chars"))
        ),
        "word_distance": F.when(
            F.col("n_words") >= limits.word_least, distance(F.col("_common"), F.col("_ref_common"))
        ),
    })
    apart = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > limits.char_distance) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > F.col("_word_limit")
    )
    return both.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(apart, F.lit(False)))


def assess(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, char_distance, word_distance``.

    Null and empty texts have no words and fail. Null or unlisted languages are judged by character
    classes only, against all documents. Repeated rows are judged each; other columns are ignored. An
    empty table gives an empty result. Features (a few numbers a row) are stored once, since the
    references need all of them before any row can be judged."""
    features = materialize(measured(docs, "doc_id"))
    return judged(features, limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance",
    )


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are, extra ones of any name included.

    Rows are named by id, hash of the text and language, so rows without an id or with a repeated one
    are judged by their own text. Those that go are joined back and taken out."""
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(whole("text")).alias("_hash"), "text", "lang")
    features = materialize(measured(keyed, "_id", "_hash"))
    gone = materialize(judged(features, limits).where(~F.col("kept")).select("_id", "_hash", "_lang").distinct())
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = (
        docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(whole(docs["text"])) == gone["_hash"])
        & docs["lang"].eqNullSafe(gone["_lang"])
    )
    return docs.join(gone, same, "left_anti")
