"""The registered queries of this package and their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm import backoff_lm
from ledgerlift.llm.best_fit import pack_documents
from ledgerlift.llm.bit_packing import read_packed, write_packed
from ledgerlift.llm.byte_bpe import round_trip_digests
from ledgerlift.llm.common import crc_mod, table
from ledgerlift.llm.conversation_repair import damage, repair_conversations
from ledgerlift.llm.jaccard_join import ngram_components
from ledgerlift.llm.line_spread import remove_boilerplate
from ledgerlift.llm.main_text import main_text
from ledgerlift.llm.merkle_manifest import merkle_manifest
from ledgerlift.llm.quality_model import fit_model, predicted, score_documents
from ledgerlift.llm.quality_rules import CLASSES, COMMON_WORDS, STEPS, Limits, quality_rules
from ledgerlift.llm.simhash_join import simhash_components
from ledgerlift.llm.top_k import quantized, top_k_inner
from ledgerlift.sources import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those that are not held out."""
    return backoff_lm.score_documents(
        table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2, order=3
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the components of those that share 85 % of their 4-word shingles."""
    found = ngram_components(table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.drop("class_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return round_trip_digests(
        table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN
    )


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fiftieth vector's five best others."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", quantized(F.col("embedding")).alias("vector")
    )
    return top_k_inner(vectors, F.col("vec_id") % 50 == 0, k=5)


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels to learn from: those of documents that are not held out."""
    return (
        table(spark, sf_dir, "labels")
        .where(crc_mod("doc_id", 5) != 0)
        .select("doc_id", F.col("quality").alias("label"))
    )


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit_model(docs, quality_labels(spark, sf_dir))
    return score_documents(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        predicted(0.3).alias("predicted"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged."""
    judged = quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.drop("class_distance", "word_distance")


def op7_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as packed files and read back."""
    path = scratch_path(spark, "packed")
    write_packed(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=1)
    return read_packed(spark, path).drop("ids")


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, end_id=0, capacity=2048)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return main_text(table(spark, sf_dir, "pages"))


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that are on many sites."""
    cleaned = remove_boilerplate(table(spark, sf_dir, "documents"), "source")
    return cleaned.select("doc_id", "text", "n_lines", "n_boilerplate", "n_removed")


def op11_simhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the components of fingerprints at most two bits apart."""
    return simhash_components(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    given = rows.select("conv_id").distinct()
    found = repair_conversations(damage(rows)).withColumnRenamed("conv_id", "_conv_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return given.join(found, given["conv_id"].eqNullSafe(found["_conv_id"]), "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their proofs, each seventh or so tampered with."""
    decimal = F.col("doc_id").cast("string").cast("binary")
    return merkle_manifest(table(spark, sf_dir, "documents"), F.crc32(decimal) % 7 == 0)


_JACCARD_SQL = r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
            lambda w: w <> '') AS words
        FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, unnest(list_transform(
            range(1, greatest(len(words) - 3, 1) + 1),
            lambda i: array_to_string(words[i:i + 3], ' '))) AS gram
        FROM split WHERE len(words) > 0),
    sizes AS (
        SELECT s.doc_id, count(g.gram) AS n_shingles
        FROM split s LEFT JOIN grams g USING (doc_id) GROUP BY s.doc_id),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM common
        JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id
        WHERE 100 * n >= 85 * (s.n_shingles + t.n_shingles - n)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (
        SELECT a, b FROM both_ways
        UNION
        SELECT r.a, w.b FROM reached r JOIN both_ways w ON r.b = w.a)
    SELECT s.doc_id, n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
    FROM sizes s LEFT JOIN reached r ON s.doc_id = r.a GROUP BY s.doc_id, n_shingles"""


def _quality_rules_sql(limits: Limits = Limits()) -> str:
    """The rules with the same fixed values; windows, classes and distances written as SQL."""
    classes = [f"len(regexp_replace(t, '[^{c}]+', '', 'g'))" for c in CLASSES.values()]
    rest = "".join(CLASSES.values())
    classes.append(f"len(regexp_replace(t, '[{rest}]+', '', 'g'))")
    words = [f"len(list_filter(words, lambda w: w = '{w}'))" for w in COMMON_WORDS]
    others = " - ".join(["len(words)", *words])

    def shares(counts: str) -> str:
        return (
            f"list_transform({counts}, lambda x: CASE WHEN list_sum({counts}) > 0 "
            f"THEN x / list_sum({counts}) ELSE 0.0 END)"
        )

    def averages(counts: str, n: int) -> str:
        return "[" + ", ".join(f"round(avg({counts}[{i}]), 9)" for i in range(1, n + 1)) + "]"

    def distance(p: str, q: str) -> str:
        def part(a: str) -> str:
            return f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({p}[i] + {q}[i])) ELSE 0.0 END"

        terms = f"{part(f'{p}[i]')} + {part(f'{q}[i]')}"
        total = f"list_sum(list_transform(range(1, len({p}) + 1), lambda i: {terms}))"
        return f"sqrt(greatest({total} / 2, 0))"

    reference = f"""
        SELECT lang, {averages("c", len(classes))} AS rc, {averages("w", len(words) + 1)} AS rw"""
    return rf"""
    WITH split AS (
        SELECT doc_id, lang, coalesce(text, '') AS t,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                           lambda w: w <> '') AS words
        FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(words) - 1)) AS i,
               unnest(list_transform(range(1, len(words) - 1),
                   lambda i: array_to_string(words[i:i + 2], ' '))) AS three
        FROM split WHERE len(words) > 2),
    often AS (
        SELECT doc_id, i FROM (
            SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows) WHERE n > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
    counted AS (
        SELECT doc_id, lang, length(t) AS chars, len(words) AS n_words,
               length(array_to_string(words, '')) AS word_chars,
               len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
               list_filter(string_split(t, chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
               [{", ".join(classes)}] AS classes, [{", ".join([*words, others])}] AS common
        FROM split),
    histograms AS (
        SELECT DISTINCT lang, classes, common FROM counted WHERE n_words >= {limits.min_words}),
    shared AS (SELECT lang, {shares("classes")} AS c, {shares("common")} AS w FROM histograms),
    first_references AS ({reference} FROM shared GROUP BY lang),
    far AS (
        SELECT s.*, floor({STEPS} * ({distance("c", "rc")} + {distance("w", "rw")})) AS d
        FROM shared s JOIN first_references r ON s.lang IS NOT DISTINCT FROM r.lang),
    halves AS (SELECT lang AS l, quantile_disc(d, 0.5) AS middle FROM far GROUP BY lang),
    language AS (
        {reference} FROM far JOIN halves ON lang IS NOT DISTINCT FROM l AND d <= middle
        GROUP BY lang),
    measured AS (
        SELECT k.*, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words,
               {distance("p", "rc")} AS class_distance, {distance("q", "rw")} AS word_distance
        FROM (SELECT *, {shares("classes")} AS p, {shares("common")} AS q FROM counted) k
        LEFT JOIN language l ON k.lang IS NOT DISTINCT FROM l.lang
        LEFT JOIN covered USING (doc_id)),
    judged AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               coalesce(chars >= {limits.min_chars} AND class_distance
                   > {limits.max_class_distance} + {limits.slack} / greatest(chars, 1)
               OR n_words >= {limits.min_words} AND word_distance
                   > {limits.max_word_distance}, false) AS diverges
        FROM measured)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT diverges AS kept
    FROM judged"""


_LINE_SPREAD_SQL = r"""
    WITH split AS (
        SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents),
    marked AS (
        SELECT *, trim(line, ' ') AS key,
               regexp_matches(line, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+'
                   || '[\x20\x09-\x0D]+[^\x20\x09-\x0D]+')
                   OR length(trim(line, ' ')) >= 20 AS long_enough
        FROM split),
    boilerplate AS (
        SELECT key FROM marked WHERE long_enough
        GROUP BY key HAVING count(DISTINCT source) >= 5),
    judged AS (
        SELECT m.*, m.long_enough AND b.key IS NOT NULL AS bad
        FROM marked m LEFT JOIN boilerplate b USING (key)),
    documents_judged AS (
        SELECT doc_id, any_value(text) AS text, count(*) AS n_lines,
               count(*) FILTER (bad) AS n_boilerplate,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS rest
        FROM judged GROUP BY doc_id),
    decided AS (
        SELECT *, n_boilerplate > 0
                  AND 9 * (length(text) - length(rest)) <= 8 * length(text) AS cleaned
        FROM documents_judged)
    SELECT doc_id, CASE WHEN cleaned THEN rest ELSE text END AS text, n_lines, n_boilerplate,
           CASE WHEN cleaned THEN n_boilerplate ELSE 0 END AS n_removed
    FROM decided"""


_TOP_K_SQL = """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_dot_product(q.vector, c.vector) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM pairs)
    WHERE rank <= 5"""


def queries() -> dict[str, Query]:
    return {
        "op1_backoff_lm": op1_backoff_lm,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_top_k": op4_top_k,
        "op5_quality_model": op5_quality_model,
        "op6_quality_rules": op6_quality_rules,
        "op7_bit_packing": op7_bit_packing,
        "op8_best_fit": op8_best_fit,
        "op9_main_text": op9_main_text,
        "op10_line_spread": op10_line_spread,
        "op11_simhash_join": op11_simhash_join,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jaccard_join": _JACCARD_SQL,
        "op4_top_k": _TOP_K_SQL,
        "op6_quality_rules": _quality_rules_sql(),
        "op10_line_spread": _LINE_SPREAD_SQL,
    }
