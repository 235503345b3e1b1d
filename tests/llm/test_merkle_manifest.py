import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import merkle_manifest as module
from ledgerlift.llm import registry
from ledgerlift.llm.merkle_manifest import fold, merkle_manifest, siblings

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def plain_tree(hashes):
    """The root, and each leaf's siblings as (own place in the run, the run) pairs."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[k : k + 2] for k in range(0, len(level), 2)]
        for leaf, k in enumerate(at):
            paths[leaf].append((k % 2, runs[k // 2]))
        at, level = [k // 2 for k in at], [digest(*run) for run in runs]
    return level[0], paths


def plain_manifest(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = plain_leaf(doc_id, text, lang, source, n_chars)
        shown = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None:
            shown = plain_leaf(doc_id, text, lang, source, n_chars + 1)
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, shown, doc_id))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {lang: plain_tree([leaf for *_, leaf, _, _ in sorted(trees[lang])]) for lang in order}
    root, tops = plain_tree([made[lang][0] for lang in order]) if order else (None, [])
    for lang, top in zip(order, tops, strict=True):
        subroot, paths = made[lang]
        for (_, _, leaf, shown, doc_id), path in zip(sorted(trees[lang]), paths, strict=True):
            others = [h for own, run in path + top for k, h in enumerate(run) if k != own]
            folded = shown
            for own, run in path + top:
                folded = digest(*(folded if k == own else h for k, h in enumerate(run)))
            yield doc_id, leaf, subroot, root, digest(*others), folded, folded == root


def check(df, rows):
    got = sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)
    assert got == sorted(plain_manifest(rows), key=repr)
    return got


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_matches_plain_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(module, "LEVELS", levels)
    rng = random.Random(levels)
    langs = ["en"] * 30 + ["de"] * 9 + ["é", "z", "", None] + [f"l{i}" for i in range(5)]
    rows = [(rng.randrange(10**6), f"t{i}\nü", rng.choice(langs), "s", i) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = check(merkle_manifest(df, tampered()), rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 8, 9, 17])
def test_tree_sizes(spark, monkeypatch, count):
    monkeypatch.setattr(module, "LEVELS", 2)
    rows = [(i, "t", "en", "s", 1) for i in range(count)]
    check(merkle_manifest(spark.createDataFrame(rows, SCHEMA), tampered()), rows)


def test_query_matches_plain_trees(spark, sf_dir, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    df = registry.queries()["op13_merkle_manifest"](spark, sf_dir)
    got = check(df, rows)
    assert all(r[-1] == (zlib.crc32(str(r[0]).encode()) % 7 != 0) for r in got)


def test_odd_rows(odd_documents):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [tuple(r) for r in odd_documents.select(*names).collect()]
    rows += [(2**62 + 1, "large id", "en", None, 2**63 - 1)] * 2
    spark = odd_documents.sparkSession
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.withColumns({c: F.lit("x") for c in ("tree", "hash", "low", "path", "root", "leaves")})
    check(merkle_manifest(extra, tampered()), rows)


def test_no_rows(no_documents):
    assert merkle_manifest(no_documents).count() == 0


def test_untampered_rows_are_verified(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(20)]
    assert all(r.verified for r in merkle_manifest(spark.createDataFrame(rows, SCHEMA)).collect())


def test_interval_difference_is_the_sibling():
    level = [(0, 2, "a" * 64), (2, 4, "b" * 64), (4, 5, "c" * 64)]
    above = [(0, 4, digest("a" * 64, "b" * 64)), (4, 5, digest("c" * 64))]
    assert siblings(level, above) == ["R" + "b" * 64, "L" + "a" * 64, "-"]
    assert fold("a" * 64, "R" + "b" * 64 + "-") == digest(above[0][2])
