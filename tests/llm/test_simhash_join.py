import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlift.llm import registry
from ledgerlift.llm import simhash_join
from ledgerlift.llm.simhash_join import fingerprint, segment_counts, simhash_components
from test_jaccard_join import least_reachable


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(rows):
    """(doc_id, fingerprint, component_id) rows, comparing all distinct fingerprints."""
    prints = [plain_fingerprint(t) for _, t in rows]
    first, links = {}, []
    for i, p in enumerate(prints):
        links.append((i, first.setdefault(p, i)))
    distinct = list(first.items())
    for k, (p, i) in enumerate(distinct):
        links += [(i, j) for q, j in distinct[:k] if (p ^ q).bit_count() <= 2]
    labels = least_reachable(len(rows), links, [i for i, _ in rows])
    return sorted(
        ((i, f"{p:016x}", label) for (i, _), p, label in zip(rows, prints, labels, strict=True)),
        key=repr,
    )


def found(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def near_copies(rng, count, length):
    words = [f"w{rng.randrange(300)}" for _ in range(length)]
    for _ in range(count):
        copy = list(words)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(length)] = f"new{rng.randrange(50)}"
        yield " ".join(copy)


@pytest.mark.parametrize("crowd", [1, 3, 65])
def test_matches_brute_force(spark, crowd):
    rng = random.Random(crowd)
    texts = [t for n in (30, 200, 600) for t in near_copies(rng, 60, n)]
    texts += [" ".join(f"v{rng.randrange(9)}" for _ in range(rng.randint(0, 5))) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = found(simhash_components(docs, crowd=crowd))
    assert got == brute_force(rows)
    assert len({c for _, _, c in got}) < len({p for _, p, _ in got})


def test_query_matches_brute_force(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(registry.queries()["op11_simhash_join"](spark, sf_dir)) == brute_force(rows)


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    clashing = odd_documents.withColumns({c: F.lit("x") for c in ("fingerprint", "root", "cell")})
    assert found(simhash_components(clashing)) == brute_force(rows)


def test_no_rows(no_documents):
    assert simhash_components(no_documents).count() == 0


def test_slices_do_not_change_fingerprints(monkeypatch):
    rng = random.Random(5)
    texts = ["", " ", "one", "one two", "Ünï " * 40, "x" * 500, " a\tb\x0bc\x1cd  e "]
    texts += [" ".join("ab"[rng.randrange(2)] * rng.randint(1, 9) for _ in range(80)) for _ in range(20)]
    expected = [plain_fingerprint(t) for t in texts]
    for size in (1, 7, 64, 1 << 18):
        monkeypatch.setattr(simhash_join, "SLICE", size)
        assert [fingerprint(t.encode()) for t in texts] == expected


def test_grid_distance_is_a_lower_bound(spark):
    rng = random.Random(7)
    numbers = [rng.getrandbits(64) - (1 << 63) for _ in range(200)] + [0, -1, 1 << 62, -(1 << 63)]
    df = spark.createDataFrame([(x,) for x in numbers], "x bigint")
    points = [
        [(r.p >> k) & 3 for k in range(0, 64, 2)]
        for r in df.select(segment_counts(F.col("x")).alias("p")).collect()
    ]
    for x, p in zip(numbers, points, strict=True):
        assert p == [(x >> k & 3).bit_count() for k in range(0, 64, 2)]
    for x, p in zip(numbers, points, strict=True):
        for y, q in zip(numbers[:40], points, strict=False):
            apart = ((x ^ y) & (1 << 64) - 1).bit_count()
            assert sum(abs(a - b) for a, b in zip(p, q, strict=True)) <= apart
