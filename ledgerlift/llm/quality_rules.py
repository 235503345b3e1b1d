"""Quality rules: repetition, length, and the divergence of a text from its language.

A document's characters fall into classes and its common words into bins. Both histograms are
compared with those of its language by Jensen-Shannon distance (base 2, so 0 to 1). The language
references come from all documents: an average over distinct histograms, made anew from the
nearer half, so that neither copies nor a share of junk can draw it away. Texts under a minimum
length are not judged by a histogram, whose noise would decide. However many languages there are,
each has a reference of its own: they are a table, joined by language.

Built-in functions alone, and nothing is shuffled but counts.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; documents
without a language are one more; where none of a language's texts is long enough for a reference
the base rule decides alone; a language whose common words are not in the list has but one bin of
words, which tells nothing; repeated rows are judged each, alike; windows of words are compared by
their 64-bit hashes; a very long text's words are one row's array; an empty table gives no rows; a
column of the documents with the name of a result is replaced by it, others pass whatever their
names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import text_or_empty, written

SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the languages at hand.
COMMON_WORDS = (
    "the of and to in that is for "
    "der die und den von zu das ist "
    "de la le les et des un est "
    "que el en los del las por con"
).split()

#: A character belongs to the first class that has it; those of none are the last bin. The
#: largest classes come first: what they take need not be looked at again.
CLASSES = {
    "lower": r"\p{Ll}",
    "space": SPACE,
    "upper": r"\p{Lu}",
    "digit": r"\p{Nd}",
    "stop": ".,;:",
    "shout": "!?",
    "symbol": SYMBOLS,
}


FEATURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "class_counts",
    "word_counts",
]


class Limits(NamedTuple):
    """Guards and thresholds of the two distances."""

    #: Shorter texts are not judged by their characters.
    min_chars: int = 200
    #: A class distance may be this, and so much more in short texts: ``slack / characters``.
    max_class_distance: float = 0.165
    slack: float = 25.0
    #: Texts of fewer words are not judged by their common words.
    min_words: int = 100
    max_word_distance: float = 0.45


#: Results that the judgement adds.
RESULTS = ["class_distance", "word_distance", "base_failed", "kept"]
#: Steps in which the distances of a language's texts are ranked to find the nearer half.
STEPS = 10_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def _without(text: Column, taken: str) -> Column:
    """The text without a class of characters, run by run."""
    return F.regexp_replace(text, f"[{taken}]+", "")


def _class_counts(text: Column, narrower: list[Column]) -> Column:
    """Characters of each class; ``narrower`` are the texts left by the first classes."""
    left, counts = [text, *narrower], []
    for i, taken in enumerate(CLASSES.values()):
        after = left[i + 1] if i + 1 < len(left) else _without(left[-1], taken)
        if i < len(narrower):
            counts.append(F.length(left[i]) - F.length(after))
        else:
            counts.append(F.length(left[-1]) - F.length(_without(left[-1], taken)))
    rest = F.length(_without(left[-1], "".join([*CLASSES.values()][len(narrower) :])))
    return F.array(*(c.cast("bigint") for c in [*counts, rest]))


def _word_bins(words: Column) -> Column:
    """The bin of each common word, from 1."""
    forms = F.lit(COMMON_WORDS)
    common = F.filter(words, lambda w: w.isin(COMMON_WORDS))
    return F.transform(common, lambda w: F.array_position(forms, w))


def _word_counts(bins: Column, n_words: Column) -> Column:
    counts = [
        (F.size(bins) - F.size(F.array_remove(bins, F.lit(k).cast("bigint")))).cast("bigint")
        for k in range(1, len(COMMON_WORDS) + 1)
    ]
    return F.array(*counts, (n_words - F.size(bins)).cast("bigint"))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    # The total is bound to a name, so that it is added up once.
    return F.flatten(
        F.transform(
            F.array(total),
            lambda n: F.transform(counts, lambda x: F.when(n > 0, x / n).otherwise(0.0)),
        )
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _with_reference(rows: DataFrame, references: DataFrame, how: str) -> DataFrame:
    """Rows with ``lang`` and the two histograms of their language as ``ref_classes``, ``ref_words``."""
    named = references.select(
        F.col("lang").alias("ref_lang"),
        F.col("classes").alias("ref_classes"),
        F.col("words").alias("ref_words"),
    )
    return rows.join(named, rows["lang"].eqNullSafe(named["ref_lang"]), how).drop("ref_lang")


def fit_references(featured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``lang``, ``classes`` and ``words``: the reference of each language, from :func:`features`.

    Each is an average over distinct pairs of histograms: copies of a text count once.
    """
    histograms = featured.where(F.col("n_words") >= limits.min_words).select(
        F.col("lang").cast("string").alias("lang"),
        F.col("class_counts").alias("classes"),
        F.col("word_counts").alias("words"),
    )
    distinct = written(histograms.dropDuplicates(), "histograms")
    shares = distinct.select(
        "lang", _shares(F.col("classes")).alias("classes"), _shares(F.col("words")).alias("words")
    )
    first = written(_averages(shares), "first-references")
    apart = distance(F.col("classes"), F.col("ref_classes")) + distance(
        F.col("words"), F.col("ref_words")
    )
    far = _with_reference(shares, first, "inner").withColumn(
        "step", F.floor(apart * STEPS).cast("int")
    )
    # The middle step of each language, from the counts of its steps.
    counts = far.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n"))
    of_lang = Window.partitionBy("lang")
    below = of_lang.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    half = 2 * F.sum("n").over(below) >= F.sum("n").over(of_lang)
    middle = (
        counts.withColumn("half", half)
        .where("half")
        .groupBy(F.col("lang").alias("mid_lang"))
        .agg(F.min("step").alias("middle"))
    )
    nearer = far.join(
        middle, far["lang"].eqNullSafe(middle["mid_lang"]) & (far["step"] <= middle["middle"])
    )
    return written(_averages(nearer.select("lang", "classes", "words")), "references")


def _averages(shares: DataFrame) -> DataFrame:
    """The mean histograms of each language; bin by bin, so that no row has an aggregate for each."""
    bins = shares.select("lang", F.posexplode(F.concat("classes", "words")).alias("bin", "share"))
    # Averages of doubles depend on the order of the rows in their last digits; rounding them
    # gives every run the same references.
    means = bins.groupBy("lang", "bin").agg(F.round(F.avg("share"), 9).alias("mean"))
    in_order = F.array_sort(F.collect_list(F.struct("bin", "mean")))
    both = F.transform(in_order, lambda x: x["mean"])
    first = len(CLASSES) + 1
    return means.groupBy("lang").agg(
        F.slice(both, 1, first).alias("classes"),
        F.slice(both, first + 1, len(COMMON_WORDS) + 1).alias("words"),
    )


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of each text and its two histograms.

    Each step's arrays are columns of their own, so that Spark computes them once a row.
    """
    text, words, n = F.col("_qr_text"), F.col("_qr_words"), F.col("n_words")
    hashes, windows = F.col("_qr_hashes"), F.col("_qr_windows")
    in_order, pairs, starts = F.col("_qr_sorted"), F.col("_qr_pairs"), F.col("_qr_starts")
    none = F.lit(0).cast("bigint")
    given = [c for c in docs.columns if c not in FEATURES]
    steps = docs.select(
        F.struct(*given).alias("_qr_row") if given else F.lit(None).alias("_qr_row"),
        text_or_empty().alias("_qr_text"),
        words_of(text_or_empty()).alias("_qr_words"),
    )
    steps = steps.withColumns(
        {
            "n_words": F.size(words).cast("bigint"),
            "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
            "_qr_no_lower": _without(text, CLASSES["lower"]),
            "_qr_bins": _word_bins(words),
            "_qr_lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)),
            "_qr_hashes": F.transform(words, lambda w: F.xxhash64(w)),
        }
    )
    steps = steps.withColumn("_qr_marks", _without(F.col("_qr_no_lower"), SPACE))
    steps = steps.withColumns(
        {
            "n_symbols": F.length(
                F.regexp_replace(F.col("_qr_marks"), f"[^{SYMBOLS}]+", "")
            ).cast("bigint"),
            "n_dup_lines": (
                F.size("_qr_lines") - F.size(F.array_distinct("_qr_lines"))
            ).cast("bigint"),
            "class_counts": _class_counts(text, [F.col("_qr_no_lower"), F.col("_qr_marks")]),
            "word_counts": _word_counts(F.col("_qr_bins"), n),
            "_qr_windows": F.slice(
                F.transform(
                    hashes,
                    lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
                ),
                1,
                F.greatest(F.size(hashes) - 2, F.lit(0)),
            ),
        }
    )
    # A text that repeats no window needs no positions.
    steps = steps.withColumn("_qr_any", F.size(F.array_distinct(windows)) < F.size(windows))
    steps = steps.withColumn(
        "_qr_pairs",
        F.when(
            F.col("_qr_any"),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    steps = steps.withColumn(
        "_qr_starts",
        F.sort_array(
            F.transform(
                F.filter(
                    pairs,
                    lambda p, k: p["h"].eqNullSafe(F.get(pairs, k + 1)["h"])
                    | p["h"].eqNullSafe(F.get(pairs, k - 1)["h"]),
                ),
                lambda p: p["i"],
            )
        ),
    )
    covered = F.transform(
        starts, lambda s, k: F.least(F.coalesce(F.get(starts, k + 1) - s, F.lit(3)), F.lit(3))
    )
    repeated = F.aggregate(covered, none, lambda a, x: a + x)
    steps = steps.withColumn("n_repeat_words", F.coalesce(repeated, none))
    return steps.select(*(F.col("_qr_row").getField(c).alias(c) for c in given), *FEATURES)


def judge(featured: DataFrame, references: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rows of :func:`features` with their distances, ``base_failed`` and ``kept``.

    Give it written features: a filter on ``kept`` would move Spark to compute them again for the
    filter.
    """
    given = [c for c in featured.columns if c not in RESULTS + ["class_counts", "word_counts"]]
    rows = featured.select(
        F.struct(*given).alias("row"),
        F.col("lang").cast("string").alias("lang"),
        "class_counts",
        "word_counts",
        "n_words",
        "n_repeat_words",
        F.aggregate("class_counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("chars"),
    )
    n, chars = F.col("n_words"), F.col("chars")
    # Without a reference its histograms, and so the distances, are null.
    class_distance = distance(_shares(F.col("class_counts")), F.col("ref_classes"))
    word_distance = distance(_shares(F.col("word_counts")), F.col("ref_words"))
    known = F.col("ref_classes").isNotNull()
    steps = _with_reference(rows, references, "left").withColumns(
        {
            "class_distance": F.when(known & (chars >= limits.min_chars), class_distance),
            "word_distance": F.when(known & (n >= limits.min_words), word_distance),
            "base_failed": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        }
    )
    most = limits.max_class_distance + limits.slack / F.greatest(chars, F.lit(1))
    no = F.lit(False)
    diverges = F.coalesce(F.col("class_distance") > most, no) | F.coalesce(
        F.col("word_distance") > limits.max_word_distance, no
    )
    judged = steps.withColumn("kept", ~F.col("base_failed") & ~diverges)
    return judged.select(*(F.col("row").getField(c).alias(c) for c in given), *RESULTS)


def quality_rules(
    docs: DataFrame, columns: list[str] | None = None, limits: Limits = Limits()
) -> DataFrame:
    """Every row of ``docs`` judged against references that are fitted on all of them.

    ``columns`` are those of ``docs`` to return; all without it. The features are written once,
    with these columns and ``lang``, and read by the fit and by the judgement.
    """
    wanted = list(docs.columns if columns is None else columns)
    chosen = dict.fromkeys([*wanted, "lang", *FEATURES])
    kept = written(features(docs).select(*chosen), "features")
    judged = judge(kept, fit_references(kept, limits), limits)
    return judged if "lang" in wanted else judged.drop("lang")
