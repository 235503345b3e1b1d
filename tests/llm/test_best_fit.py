import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlift.llm import registry
from ledgerlift.llm.best_fit import pack_documents, plan_packing, sequences

TOKENIZER = Tokenizer.from_file(registry.WORD_BPE)


def fewest(lengths, capacity):
    """The optimal number of bins, by search."""
    best = len(lengths)
    ordered = sorted(lengths, reverse=True)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(ordered):
            best = len(bins)
            return
        for room in {*bins}:
            if room >= ordered[i]:
                k = bins.index(room)
                put(i + 1, bins[:k] + [room - ordered[i]] + bins[k + 1 :])
        put(i + 1, [*bins, capacity - ordered[i]])

    put(0, [])
    return best


def check_plan(histogram, patterns, capacity):
    held = Counter()
    for items, bins in patterns:
        assert bins > 0 and sum(length * k for length, k in items) <= capacity
        for length, k in items:
            held[length] += bins * k
    assert held == Counter(histogram)
    return sum(bins for _, bins in patterns)


@pytest.mark.parametrize("seed", range(60))
def test_plan_against_search(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 30])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 11))]
    bins = check_plan(Counter(lengths), plan_packing(Counter(lengths), capacity), capacity)
    assert bins <= fewest(lengths, capacity) + (1 if len(lengths) > 8 else 0)


def test_plan_does_not_grow_with_the_counts():
    few = {n: 3 + n % 7 for n in range(1, 2049)}
    many = {n: c * 10**9 for n, c in few.items()}
    patterns = plan_packing(many, 2048)
    bins = check_plan(many, patterns, 2048)
    assert len(patterns) < 20_000
    assert bins <= math.ceil(sum(n * c for n, c in many.items()) / 2048) * 1.01


def check_rows(rows, texts, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by_sequence.values():
        placed.sort()
        ends = list(itertools.accumulate(n for _, n in placed))
        assert [o for o, _ in placed] == [0, *ends[:-1]] and ends[-1] <= capacity
    expected = []
    for doc_id, text in texts:
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            crc = zlib.crc32(np.array(own, "<u4").tobytes())
            expected.append((doc_id, piece, at, len(own), crc))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    return len(by_sequence), sum(r.length for r in rows)


def test_query_matches_brute_force(spark, sf_dir, documents):
    rows = registry.queries()["op8_best_fit"](spark, sf_dir).collect()
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    bins, tokens = check_rows(rows, texts, 2048)
    assert bins <= math.ceil(tokens / 2048) + 2


def test_odd_rows_and_sequences(spark, odd_documents):
    packed = pack_documents(odd_documents, registry.WORD_BPE, 0, capacity=64, keep_ids=True)
    rows = packed.collect()
    check_rows(rows, [(r.doc_id, r.text) for r in odd_documents.collect()], 64)
    by_id = {r.sequence_id: r for r in sequences(packed).collect()}
    for r in rows:
        whole = by_id[r.sequence_id].ids
        assert bytes(whole)[r.offset * 4 : (r.offset + r.length) * 4] == bytes(r.ids)


def test_no_rows(no_documents):
    assert pack_documents(no_documents, registry.WORD_BPE, 0).count() == 0
