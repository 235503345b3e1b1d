import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import registry
from ledgerlift.llm.components import connected_components
from ledgerlift.llm.jaccard_join import keep_one, ngram_components, ngram_join, ngram_links, overlap


def grams(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def least_reachable(count, links, ids):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    groups = {}
    for i in range(count):
        groups.setdefault(find(i), []).append(i)
    least = {root: min((ids[i] for i in g if ids[i] is not None), default=None) for root, g in groups.items()}
    return [least[find(i)] for i in range(count)]


def brute_force(rows, n, percent):
    """(doc_id, n_shingles, component_id) rows, comparing all sets that share a gram."""
    sets = [grams(t, n) for _, t in rows]
    holders, links = {}, set()
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for h in holders.values() if len(h) < 500 for a in h for b in h if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            links.add((a, b))
    labels = least_reachable(len(rows), links, [i for i, _ in rows])
    return sorted(
        ((i, len(s), label if s else i) for (i, _), s, label in zip(rows, sets, labels, strict=True)),
        key=repr,
    )


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = f"new{rng.randrange(10**6)}"
        elif kind == 1:
            out.insert(k, f"more{rng.randrange(10**6)}")
        elif len(out) > 1:
            del out[k]
    return out


@pytest.mark.parametrize("seed", range(2))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60 if seed % 2 else 3000)]
    texts, passage = [], [rng.choice(vocabulary) for _ in range(40)]
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        if rng.random() < 0.4:
            words = words[: rng.randint(1, 12)] + passage
        chain = words
        for _ in range(rng.randint(1, 14)):
            chain = edited(rng, chain if rng.random() < 0.5 else words, rng.randint(0, 4))
            texts.append(" ".join(chain) if rng.random() < 0.8 else "\n ".join(chain).upper())
    rng.shuffle(texts)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for n, percent in ((4, 85), (2, 60)):
        assert found(ngram_components(docs, n, percent)) == brute_force(rows, n, percent)


def test_large_group_of_near_copies(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(i, " ".join(edited(rng, words, rng.randint(0, 2)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(ngram_components(docs)) == brute_force(rows, 4, 85)


def test_query_matches_brute_force(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    df = registry.queries()["op2_jaccard_join"](spark, sf_dir)
    assert found(df) == brute_force(rows, 4, 85)
    assert len({r.component_id for r in df.collect()}) < len(rows)


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert found(ngram_components(odd_documents)) == brute_force(rows, 4, 85)


def test_no_rows(no_documents):
    assert ngram_components(no_documents).count() == 0


def linked(rows, n, percent):
    """How many others each document links with, by its place among the rows."""
    sets = [grams(t, n) for _, t in rows]
    return [
        sum(
            i != j and bool(x) and 100 * len(x & y) >= percent * len(x | y)
            for j, y in enumerate(sets)
        )
        for i, x in enumerate(sets)
    ]


def test_complete_join_has_every_link(spark):
    rng = random.Random(11)
    words = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [" ".join(edited(rng, words, rng.randint(0, 3))) for _ in range(150)]
    texts += texts[:5] * 3 + ["", "one two", "ONE two"] + [" ".join(edited(rng, words, 40)) for _ in range(9)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = linked(rows, 4, 85)
    got = {r.doc_id: r for r in ngram_join(docs).collect()}
    assert [got[i].n_links for i in range(len(rows))] == expected and max(expected) > 20
    assert found(ngram_join(docs)) == brute_force(rows, 4, 85)
    classes, links, _ = ngram_links(docs, complete=True)
    different = len({g for _, t in rows if (g := grams(t, 4))})
    assert classes.where("class is not null").select("class").distinct().count() == different
    pairs = {(min(r.a, r.b), max(r.a, r.b)) for r in links.collect()}
    sets = list({g for _, t in rows if (g := grams(t, 4))})
    assert links.count() == len(pairs) == sum(
        100 * len(x & y) >= 85 * len(x | y) for i, x in enumerate(sets) for y in sets[:i]
    )
    _, some, _ = ngram_links(docs)
    assert some.count() < len(pairs)


def test_complete_join_of_odd_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = sorted((repr(r.doc_id), r.n_shingles, r.n_links) for r in ngram_join(odd_documents).collect())
    links = linked(rows, 4, 85)
    assert got == sorted((repr(i), len(grams(t, 4)), k) for (i, t), k in zip(rows, links, strict=True))
    assert ngram_join(no_documents).count() == 0


def test_kept_rows_have_their_own_columns(odd_documents):
    names = ["_own_hash", "row", "own_hash", "class", "root", "_id"]
    docs = odd_documents.withColumns({c: F.lit(f"their {c}") for c in names})
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert all(r[c] == f"their {c}" for r in kept.collect() for c in names)


def test_suffix_filter_never_drops_a_match():
    rng = np.random.default_rng(3)
    for _ in range(500):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in "xy")
        common = len(np.intersect1d(x, y))
        for least in range(1, 30):
            got = overlap(x, y, least)
            assert got == common or (got == -1 and common < least)


@pytest.mark.parametrize("few", [0, 1000])
@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed, few):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    links += [(100 + i, 101 + i) for i in range(40)] + [(300, 200 + i) for i in range(50)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(df, few).collect()}
    labels = least_reachable(400, links, range(400))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: labels[i] for i in nodes}
