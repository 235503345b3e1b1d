import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import registry
from ledgerlift.llm.quality_rules import (
    CLASSES,
    COMMON_WORDS,
    Limits,
    distance,
    features,
    fit_references,
    quality_rules,
)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def class_counts(text):
    kinds = {
        "lower": str.islower, "upper": str.isupper, "digit": str.isdecimal,
        "space": lambda c: c in " \t\n\x0b\x0c\r", "stop": lambda c: c in ".,;:",
        "shout": lambda c: c in "!?", "symbol": lambda c: c in "#*$%&|<>",
    }
    found = [sum(map(kinds[name], text)) for name in CLASSES]
    return [*found, len(text) - sum(found)]


def word_counts(text):
    words = Counter(re.findall(r"[^\x20\x09-\x0D]+", text))
    found = [words[w] for w in COMMON_WORDS]
    return [*found, sum(words.values()) - sum(found)]


def js(p, q):
    p, q = ([x / sum(h) for x in h] for h in (p, q))
    terms = [
        x * math.log2(x / ((a + b) / 2)) for a, b in zip(p, q, strict=True) for x in (a, b) if x
    ]
    return math.sqrt(max(0, sum(terms) / 2))


def test_base_counts_match_brute_force(documents, odd_documents):
    for docs in (documents, odd_documents):
        rows = features(docs).select("text", *BASE, "class_counts", "word_counts").collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r[c] for c in BASE) == brute_force(r.text)
            assert r.word_counts == word_counts(r.text or "")
        ascii_rows = [r for r in rows if (r.text or "").isascii()]
        assert ascii_rows
        for r in ascii_rows:
            assert r.class_counts == class_counts(r.text or "")
        assert all(sum(r.class_counts) == len(r.text or "") for r in rows)


@pytest.mark.parametrize("seed", range(5))
def test_repeated_windows(spark, seed):
    import random

    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, lang string")
    for r in features(docs).collect():
        assert tuple(r[c] for c in BASE) == brute_force(r.text)


def test_distance(spark):
    pairs = [([1, 0], [0, 1]), ([3, 1], [3, 1]), ([5, 3, 2], [1, 1, 8])]
    for p, q in pairs:
        own = [F.array(*(F.lit(x / sum(h)) for x in h)) for h in (p, q)]
        found = spark.range(1).select(distance(*own).alias("d")).first().d
        assert found == pytest.approx(js(p, q), abs=1e-9)


def test_query_matches_brute_force(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in quality_rules(documents, ["doc_id"]).collect()}
    query = registry.queries()["op6_quality_rules"](spark, sf_dir)
    assert {r.doc_id: r.kept for r in query.collect()} == {i: r.kept for i, r in rows.items()}
    references = {r.lang: r for r in fit_references(features(documents)).collect()}
    limits = Limits()
    texts = documents.collect()
    assert len(rows) == len(texts)
    for doc in texts:
        r, text = rows[doc.doc_id], doc.text
        assert tuple(r[c] for c in BASE) == brute_force(text)
        base_failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base_failed
        far, word_far = r.class_distance, r.word_distance
        if text.isascii() and len(text) >= limits.min_chars:
            assert far == pytest.approx(js(class_counts(text), references[doc.lang].classes), abs=1e-6)
        assert (far is None) == (len(text) < limits.min_chars)
        assert (word_far is None) == (r.n_words < limits.min_words)
        if word_far is not None:
            assert word_far == pytest.approx(js(word_counts(text), references[doc.lang].words), abs=1e-6)
        diverges = (far or 0) > limits.max_class_distance + limits.slack / max(1, len(text))
        assert r.kept == (not base_failed and not diverges and (word_far or 0) <= limits.max_word_distance)


def test_keeps_clean_and_rejects_junk(spark, sf_dir):
    judged = registry.queries()["op6_quality_rules"](spark, sf_dir).where("not base_failed")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    counts = judged.join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    by = {(r.quality, r.kept): r["count"] for r in counts}
    assert by.get((1, False), 0) <= 0.01 * by[1, True]
    assert by.get((0, True), 0) <= 0.2 * by[0, False]


def test_a_third_of_copied_junk_does_not_move_the_reference(spark, documents):
    junk = " ".join(f"{w.upper()}!!" for w in "qwxy zzgh rrtt pplk mnbv".split() * 40)
    half = documents.count() // 2
    copies = spark.range(half).select(
        (F.col("id") + 10**6).alias("doc_id"), F.lit(junk).alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(1).alias("n_chars"),
    )
    judged = quality_rules(documents.unionByName(copies), ["doc_id", "lang", "text"])
    assert judged.where("doc_id >= 1000000 and class_distance < 0.3").count() == 0
    clean = quality_rules(documents, ["doc_id"]).where("kept").count()
    assert judged.where("doc_id < 1000000 and kept").count() >= 0.98 * clean


def test_every_language_has_a_reference(spark, documents):
    """Twelve clean documents in another script stay, however many languages there are."""
    rng = random.Random(2)
    letters = [chr(c) for c in range(0x0627, 0x064A)]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(400)]
    rows = [(10**6 + i, " ".join(rng.choice(words) for _ in range(300)), "ar") for i in range(12)]
    rows.append((2 * 10**6, "x" * 10 + " " + "WQ!! " * 300, "ar"))
    few = documents.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    many = F.concat(F.lit("en-"), F.pmod(F.hash("doc_id"), F.lit(40)))
    others = documents.where("lang = 'en'").select(
        (F.col("doc_id") + 10**7).alias("doc_id"), "text", many.alias("lang")
    )
    for docs in (few, few.unionByName(others)):
        judged = {r.doc_id: r.kept for r in quality_rules(docs, ["doc_id"]).where("doc_id between 1e6 and 2e6").collect()}
        assert all(judged[10**6 + i] for i in range(12))
        assert not judged[2 * 10**6]
    assert few.unionByName(others).select("lang").distinct().count() > 34


def test_documents_without_a_language_are_one_more(documents):
    none = F.when(F.col("lang") != "en", F.col("lang"))
    kept = {r.doc_id: r.kept for r in quality_rules(documents, ["doc_id"]).collect()}
    unnamed = quality_rules(documents.withColumn("lang", none), ["doc_id"]).collect()
    assert {r.doc_id: r.kept for r in unnamed} == kept


def test_the_base_rule_decides_alone_without_a_reference(spark):
    rows = [(i, " ".join(f"W{i}Q{k}!" for k in range(60)), "xx") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    judged = quality_rules(docs).collect()
    assert all(r.kept and r.class_distance is None for r in judged)


def test_columns_of_any_name_pass(odd_documents):
    names = ["_qr_text", "_qr_row", "_qr_words", "row", "ref_lang", "ref_classes", "chars", "classes", "step"]
    docs = odd_documents.withColumns({c: F.lit(f"their {c}") for c in names})
    rows = quality_rules(docs).collect()
    assert len(rows) == odd_documents.count()
    assert all(r[c] == f"their {c}" for r in rows for c in names)


def test_odd_rows(odd_documents):
    rows = quality_rules(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert set(odd_documents.columns) <= set(rows[0].asDict())
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    clashing = odd_documents.withColumns({c: F.lit("theirs") for c in ("n_words", "kept", "classes")})
    for columns in (["doc_id"], None):
        again = quality_rules(clashing, columns).collect()
        assert sorted(r.n_words for r in again) == sorted(r.n_words for r in rows)
        assert {r.kept for r in again} <= {True, False}


def test_no_rows(no_documents):
    assert quality_rules(no_documents).count() == 0
