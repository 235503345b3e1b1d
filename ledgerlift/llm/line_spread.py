"""Boilerplate lines: those on many distinct sites, found by sketches and removed everywhere.

For each line hash a HyperLogLog sketch of its sites is merged by aggregation. A line whose
estimate is clearly over or under the threshold is decided by it; for those near the threshold
the sites are counted exactly. Found lines go from every document, but for those that are made of
them almost wholly: two such documents share so much that a near-duplicate operator takes them
for copies, and one of them should stay whole.

Built-in functions alone. Line hashes are shuffled, not lines; a line of very many documents is one
sketch per task before the shuffle, and the few most frequent ones are broadcast to the joins.

Defined cases: a null text stays null and an empty one empty; lines of few words and characters are
never boilerplate, lines are compared without spaces at their ends, and an empty line is a line; a
null site is not counted; repeated rows are cleaned each, and rows that share an id, null included,
by their own texts; of a very long text, its distinct line hashes are one row's array; an empty table
gives no rows; other columns pass, whatever their names, and those named as a result are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import join_by_frequency, written

#: A line is boilerplate from so many distinct sites on.
MIN_SITES = 5
#: Lines of fewer words stay, since they recur by chance, unless they have so many characters: some
#: scripts write no spaces.
MIN_WORDS = 3
MIN_CHARS = 20
#: A document that would lose a larger share of its characters stays whole. Two texts that have such
#: a share in common are 80 % alike, which is what near copies are.
MAX_SHARE = 8 / 9
#: The sketches' size: about 2^12 registers, so an estimate is off by 1.6 % or so.
LOG_REGISTERS = 12

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_RESULTS = ("n_lines", "n_boilerplate", "n_removed")


def long_enough(line: Column, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> Column:
    """Whether a line has so many words or, without spaces at its ends, characters."""
    words = line.rlike(f"{_WORD}+" + f"{_SPACE}+{_WORD}+" * (min_words - 1))
    return words | (F.length(F.trim(line)) >= min_chars)


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _text_hash() -> Column:
    """Tells texts with one id apart."""
    return F.xxhash64("text")


def lines_of(
    docs: DataFrame, site: str, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``site`` and ``line`` (hash) of every distinct line that may be
    boilerplate."""
    hashes = F.transform(
        F.filter(_lines(F.col("text")), lambda x: long_enough(x, min_words, min_chars)), line_hash
    )
    return docs.select(
        "doc_id",
        _text_hash().alias("text_hash"),
        F.col(site).alias("site"),
        F.explode(F.array_distinct(hashes)).alias("line"),
    )


def boilerplate_lines(
    lines: DataFrame, min_sites: int = MIN_SITES, log_registers: int = LOG_REGISTERS
) -> DataFrame:
    """``line`` and ``n_rows`` of the lines (``line``, ``site``) on at least ``min_sites`` sites."""
    sketches = lines.groupBy("line").agg(
        F.hll_sketch_agg(F.col("site").cast("string"), log_registers).alias("sketch"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    estimates = sketches.select("line", "n_rows", F.hll_sketch_estimate("sketch").alias("about"))
    # Six standard errors, and one site at least.
    margin = max(1, math.ceil(min_sites * 6 * 1.04 / math.sqrt(2**log_registers)))
    wanted = written(estimates.where(F.col("about") >= min_sites - margin), "spread-lines")
    sure = wanted.where(F.col("about") > min_sites + margin).select("line", "n_rows")
    near = wanted.where(F.col("about") <= min_sites + margin).select("line", "n_rows")
    # A line's sites, each once, before they are counted: a frequent line has few of them.
    sites = join_by_frequency(lines.select("line", "site"), near, "line", "n_rows").distinct()
    counted = (
        sites.groupBy("line")
        .agg(F.count("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .join(near, "line")
    )
    return sure.unionByName(counted.select("line", "n_rows"))


def remove_boilerplate(
    docs: DataFrame,
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """``docs`` with cleaned ``text``, and ``n_lines``, ``n_removed`` and ``n_boilerplate``.

    ``n_boilerplate`` counts a row's boilerplate lines; ``n_removed`` is the same, or 0 where the
    document stays whole.
    """
    columns = [c for c in docs.columns if c not in _RESULTS]
    lines = written(lines_of(docs, site, min_words, min_chars), "lines")
    found = written(boilerplate_lines(lines, min_sites), "boilerplate")
    # Whether a line is boilerplate does not depend on which of the rows with this text has it.
    of_doc = (
        join_by_frequency(lines.select("doc_id", "text_hash", "line"), found, "line", "n_rows")
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set("line").alias("_found"))
    )
    # The others in one column, so that none of any name can clash; the text is shuffled but once.
    others = F.struct(*(c for c in columns if c != "text")).alias("_row")
    rows = docs.select(others, "doc_id", _text_hash().alias("_own"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash"))
    split = rows.join(of_doc, same, "left").withColumn("_lines", _lines(F.col("text")))
    # Short lines are not boilerplate even if their hash should be that of another line.
    kept = F.filter(
        "_lines",
        lambda x: ~(
            F.array_contains("_found", line_hash(x)) & long_enough(x, min_words, min_chars)
        ),
    )
    split = split.withColumn("_kept", F.when(F.col("_found").isNotNull(), kept).otherwise(F.col("_lines")))
    none = F.lit(0).cast("bigint")
    measured = split.withColumns(
        {
            "n_lines": F.coalesce(F.size("_lines").cast("bigint"), none),
            "n_boilerplate": F.coalesce((F.size("_lines") - F.size("_kept")).cast("bigint"), none),
            "_rest": F.array_join("_kept", "\n"),
        }
    )
    # Characters that go, with their line breaks, against those of the text.
    lost = F.length("text") - F.length("_rest")
    # A little more than the share, as it is not a whole number in binary.
    cleaned = (F.col("n_boilerplate") > 0) & (lost <= max_share * F.length("text") + 1e-6)
    out = measured.withColumn("n_removed", F.when(cleaned, F.col("n_boilerplate")).otherwise(none))
    text = F.when(F.col("n_removed") > 0, F.col("_rest")).otherwise(F.col("text"))
    given = [text.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in columns]
    return out.select(*given, *_RESULTS)
