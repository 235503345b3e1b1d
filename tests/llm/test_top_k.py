import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import registry
from ledgerlift.llm.top_k import Shard, quantized, top_k_inner


def brute_force(vectors, is_query, k):
    out = set()
    for query_id, query in {(i, tuple(v)) for i, v in vectors if is_query(i)}:
        scored = [
            (-int(np.dot(np.array(query, object), np.array(v, object))), i)
            for i, v in vectors
            if i != query_id and len(v) == len(query)
        ]
        for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
            out.add((query_id, rank, i, -score))
    return out


def search(spark, vectors, k, **sizes):
    df = spark.createDataFrame(vectors, "vec_id bigint, vector array<bigint>")
    rows = top_k_inner(df, F.col("vec_id") % 5 == 0, k, **sizes).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.mark.parametrize(("spread", "seed"), [(2, 1), (60, 2), (2**29, 3)])
def test_matches_brute_force(spark, spread, seed):
    rng = np.random.default_rng(seed)
    vectors = [(i, rng.integers(-spread, spread, 12).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(120)]  # many ties
    found = search(spark, vectors, 5, shard_rows=100, query_rows=30)
    assert found == brute_force(vectors, lambda i: i % 5 == 0, 5)


def test_pruning_is_exact_within_a_shard(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 100, (5, 16))
    vectors = [
        (i, (centres[i % 5] + rng.normal(0, 3, 16)).astype(int).tolist()) for i in range(4000)
    ]
    df = spark.createDataFrame(vectors, "vec_id bigint, vector array<bigint>")
    expected = brute_force(vectors, lambda i: i % 500 == 0, 3)
    rows = top_k_inner(df, F.col("vec_id") % 500 == 0, 3).collect()
    assert {tuple(r) for r in rows} == expected
    matrix = np.array([v for _, v in vectors], float)
    shard = Shard(np.arange(len(vectors)), matrix, 256)
    for i in range(0, 4000, 500):
        ids, scores = shard.search(i, matrix[i], 3)
        found = set(zip([i] * 3, range(1, 4), ids.tolist(), scores.tolist(), strict=True))
        assert found == {e for e in expected if e[0] == i}


def test_a_floor_leaves_out_only_what_is_below_it():
    rng = np.random.default_rng(5)
    vectors, query = rng.integers(-50, 50, (2000, 16)).astype(float), rng.integers(-50, 50, 16).astype(float)
    scores = np.sort(vectors @ query)[::-1]
    shard = Shard(np.arange(2000), vectors, 100)
    for floor in (None, scores[-1], scores[3], scores[9], scores[0], scores[0] + 1):
        _, found = shard.search(-1, query, 5, floor)
        expected = [x for x in scores[:5] if floor is None or x >= floor]
        assert found[: len(expected)].tolist() == expected
        assert all(x < floor for x in found[len(expected) :])


def test_a_query_id_with_several_vectors_and_floors(spark):
    rng = np.random.default_rng(6)
    vectors = [(i % 40, rng.integers(-9, 9, 6).tolist()) for i in range(200)]
    df = spark.createDataFrame(vectors, "vec_id bigint, vector array<bigint>")
    rows = top_k_inner(df, F.col("vec_id") == 0, 4, shard_rows=20, query_rows=2).collect()
    ranked = sorted(
        (-int(np.dot(q, v)), i) for j, q in vectors if j == 0 for i, v in vectors if i != 0
    )
    assert [(r.rank, -r.score) for r in sorted(rows, key=lambda r: r.rank)] == [
        (rank, score) for rank, (score, _) in enumerate(ranked[:4], 1)
    ]


def test_few_candidates(spark):
    assert search(spark, [(0, [1, 2]), (1, [3, 4])], 5) == {(0, 1, 1, 11)}
    assert search(spark, [(0, [1, 2])], 5) == set()
    assert search(spark, [], 5) == set()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.001], "a"),
        (1, [1.0, 1.0], "a"),
        (2, None, "a"),
        (3, [None, 1.0], "a"),
        (4, [nan, 1.0], "a"),
        (5, [-inf, 1.0], "a"),
        (6, [1.0], "a"),
        (7, [], "a"),
        (10, [], None),
        (0, [0.5, -0.001], "repeated"),
        (None, [1.0, 1.0], "a"),
        (8, [1.0, 1.0], "tie"),
        (8, [1.0, 1.0], "repeated"),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, shard string")
    vectors = df.select("vec_id", quantized(F.col("embedding")).alias("vector"), "shard")
    found = top_k_inner(vectors, F.col("vec_id") % 5 == 0, 5).orderBy("query_id", "rank").collect()
    score = 128 * 256 - 256
    assert [tuple(r) for r in found] == [
        (0, 1, 1, score), (0, 2, 8, score), (0, 3, 8, score), (10, 1, 7, 0),
    ]


def test_query_matches_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = [
        (r.vec_id, np.floor(256 * np.array(r.embedding, np.float64)).astype(int).tolist())
        for r in rows
    ]
    found = registry.queries()["op4_top_k"](spark, sf_dir).collect()
    assert {tuple(r) for r in found} == brute_force(vectors, lambda i: i % 50 == 0, 5)
