import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import registry
from ledgerlift.llm.backoff_lm import (
    PRIOR,
    Automaton,
    Chunk,
    Piece,
    pieces_of,
    score_documents,
    squeeze,
    squeeze_ascending,
    unsqueeze,
    unsqueeze_ascending,
)

END = None


def tokens_of(text):
    return [*(text or "").encode().lower().split(), END]


class Model:
    """The model's definition, written out: counts in dicts and a recursion over orders."""

    def __init__(self, texts, order, prior=PRIOR):
        self.order, self.prior, self.counts = order, prior, [Counter() for _ in range(order)]
        self.contexts = [Counter() for _ in range(order)]
        for text in texts:
            tokens = tokens_of(text)
            for i, token in enumerate(tokens):
                for n in range(min(order, i + 2)):
                    context = self.context(tokens, i, n)
                    self.counts[n][context, token] += 1
                    self.contexts[n][context] += 1
        self.n, self.types = self.contexts[0][()], len(self.counts[0])

    @staticmethod
    def context(tokens, i, n):
        return tuple((["<start>"] + tokens)[i + 1 - n : i + 1])

    def probability(self, context, token):
        n = len(context)
        if not n:
            return (self.counts[0][(), token] + 1) / (self.n + self.types + 1)
        lower = self.probability(context[1:], token)
        seen = self.counts[n][context, token] if self.contexts[n][context] else 0
        return (seen + self.prior * lower) / (self.contexts[n][context] + self.prior)

    def row(self, text):
        tokens = tokens_of(text)
        score = sum(
            math.log10(self.probability(self.context(tokens, i, min(self.order - 1, i + 1)), t))
            for i, t in enumerate(tokens)
        )
        base = sum(math.log10(self.probability((), t)) for t in tokens)
        known = sum(self.counts[0][(), t] > 0 for t in tokens)
        return len(tokens), known, self.n, pytest.approx(base), pytest.approx(score)


def check(df, rows, order):
    model = Model([t for _, t, held in rows if not held], order)
    expected = sorted(((i, t, held) for i, t, held in rows), key=lambda r: (r[0] is None, r[0], len(r[1] or "")))
    got = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens))
    assert len(got) == len(expected)
    for r, (doc_id, text, held) in zip(got, expected, strict=True):
        assert (r.doc_id, r.held_out) == (doc_id, held)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == model.row(text)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_matches_definition(spark, order):
    rng = np.random.default_rng(order)
    rows = [(i, " ".join(rng.choice(list("abcdefG"), rng.integers(0, 12))), i % 3 == 0) for i in range(60)]
    rows += [(100, "never seen words", True), (101, None, True), (102, "", False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, out boolean").repartition(3)
    check(score_documents(df, F.col("out"), order, chunk_tokens=50, bucket_keys=40), rows, order)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_sum_to_one(order):
    texts = [b"a b a c", b"b b a", b"c"]
    chunk = Chunk.of_texts(texts, [False] * 3)
    levels = chunk.grams(order)
    totals = [chunk.training_counts(g) for g in levels]
    model = Automaton(levels, totals, 3, int(chunk.lengths.sum()), len(chunk.words), 2.0)
    words = range(len(chunk.words))
    end = chunk.tokens[chunk.lengths[0] - 1]  # nothing follows it
    inner = [w for w in words if w != end]
    unknown = -(10**9)  # a token without any arc
    for prefix in [(), *product(inner, repeat=1), *product(inner, repeat=2)]:
        before = model.score(list(prefix))
        following = [10 ** (model.score([*prefix, w]) - before) for w in [*words, unknown]]
        assert sum(following) == pytest.approx(1)


def test_query_matches_definition(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in documents.collect()]
    df = registry.queries()["op1_backoff_lm"](spark, sf_dir)
    check(df, rows, 3)
    held = df.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_query_counts_trigrams(spark, tmp_path):
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(list("abcd"), 30)) for _ in range(80)]
    rows = [(i, t, zlib.crc32(str(i).encode()) % 7 == 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    check(registry.queries()["op1_backoff_lm"](spark, str(tmp_path)), rows, 3)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_long_texts_in_pieces(spark, order):
    rng = np.random.default_rng(order)
    rows = [(i, " ".join(rng.choice(list("abcdefG"), n)), i % 3 == 0) for i, n in enumerate([900, 5, 1300, 700])]
    rows += [(9, "x" * 50 + " " + "y" * 90 + " z", False), (9, " " * 70 + "a b", False), (None, "a " * 99, True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, out boolean").repartition(2)
    for size in (1, 25, 1000):
        scored = score_documents(
            df, F.col("out"), order, chunk_tokens=300, bucket_keys=100, slice_bytes=size
        )
        check(scored, rows, order)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lockstep_is_the_traversal(order):
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(list("abcdefgh"), n)).encode() for n in (0, 1, 3, 700, 1500, 511, 512, 513)]
    chunk = Chunk.of_texts(texts, [i % 2 == 0 for i in range(len(texts))])
    levels = chunk.grams(order)
    totals = [chunk.training_counts(g) for g in levels]
    model = Automaton(levels, totals, 4, int(chunk.lengths[~chunk.held].sum()), int((totals[0] > 0).sum()), 2.0)
    bounds = zip(chunk.starts, chunk.starts + chunk.lengths, strict=True)
    expected = [model.score(chunk.tokens[i:j].tolist()) for i, j in bounds]
    assert model.score_pieces(chunk) == pytest.approx(expected, abs=1e-9)


def test_pieces():
    text = b" one two  three four five\n six "
    words = text.split()
    for lead in range(4):
        for size in range(1, 40):
            pieces = list(pieces_of(text, lead, size))
            assert [w for p in pieces for w in p.words[p.lead :]] == words
            assert [p.last for p in pieces] == [False] * (len(pieces) - 1) + [True]
            assert pieces[0].lead == 0 and all(p.lead == lead for p in pieces[1:])
    assert list(pieces_of(b" ", 2)) == [Piece([], 0, True)]


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text, r.doc_id == 7) for r in odd_documents.collect()]
    check(score_documents(odd_documents, F.col("doc_id") == 7), rows, 2)


def test_no_training_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = score_documents(df, F.lit(True)).collect()
    assert {(r.doc_id, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {
        (1, 0, 0, 0.0, 0.0),
        (2, 0, 0, 0.0, 0.0),
    }


def test_no_rows(no_documents):
    assert score_documents(no_documents, F.lit(False)).count() == 0


def test_squeezed_integers():
    rng = np.random.default_rng(1)
    for size in (0, 1, 1000):
        values = rng.integers(0, 2**57, size)
        assert (unsqueeze(squeeze(values)) == values).all()
        values.sort()
        assert (unsqueeze_ascending(squeeze_ascending(values)) == values).all()
