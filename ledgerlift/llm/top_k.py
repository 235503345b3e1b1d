"""Exact top-k by inner product with MaxScore over shards of the candidates.

A query's terms are its non-zero components; a term's postings are the vectors whose component
has the same sign, so that a posting adds to the score. The bound of a term in a block is the
query's component times the largest posting there. Terms are split by bounds: those of the
smallest bounds that together stay below the k-th score so far are non-essential, and a vector
outside the essential postings cannot enter the top k. The essential postings are traversed; the
other terms are probed, largest bound first, for as long as a vector's score so far plus the
bounds of what is left can still compete. Components of opposite sign only lower a score; they
are added with the term that they belong to.

Shards of the candidates meet blocks of queries, each such cell gives its own top k, and the
cells' lists are merged. One shard comes first: its k-th score is a floor with which a query begins
in all others, so that there terms are non-essential and vectors not competitive from the first
block on. Cells are as large as a task's memory allows, as each vector is dealt to every block.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, nor do
rows without an id or vectors of another length than their query; ties go to the smaller id; rows
that repeat an id are candidates each, and all rows of a query's id are left out; an empty vector
scores 0 with other empty ones; an empty table gives no rows; other columns are ignored. Components
are integers; where sums of products could pass 2^63 they wrap, far beyond what ``quantized`` makes
of embeddings. A very long vector is one row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import parts_for, written

#: Candidates of a shard, and queries of a block, about.
SHARD_ROWS = 8192
QUERY_ROWS = 16384
#: Vectors that are traversed together; bounds are those of such a block.
BLOCK_ROWS = 4096


def quantized(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component, from doubles; null if one is null or not finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")),
    )
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(finite, scaled)


def _order(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Best first: higher score, then smaller id."""
    return np.lexsort((ids, -scores))


class Shard:
    """Candidates of one length, in blocks with the bounds of their components."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block_rows: int = BLOCK_ROWS):
        # Postings by dimension: traversing a term reads one contiguous row.
        self.blocks = []
        for i in range(0, len(ids), block_rows):
            part = vectors[i : i + block_rows]
            high = part.max(axis=0, initial=0)
            low = part.min(axis=0, initial=0)
            self.blocks.append((ids[i : i + block_rows], np.ascontiguousarray(part.T), high, low))

    def search(
        self, own_id: int, query: np.ndarray, k: int, least: float | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best other candidates, best first.

        Those under ``least`` need not be found.
        """
        best_ids = np.empty(0, np.int64)
        best = np.empty(0, np.int64)
        for ids, postings, high, low in self.blocks:
            bounds = np.where(query > 0, query * high, query * low)
            terms = np.argsort(-bounds, kind="stable")
            # What the terms from each place on can add at most.
            rest = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)
            floor = best[k - 1] if len(best) >= k else least
            if floor is not None and least is not None:
                floor = max(floor, least)
            if floor is not None and rest[0] < floor:
                continue
            # Essential are the terms up to the first whose rest stays below the floor.
            essential = len(terms) if floor is None else int(np.argmax(rest < floor))
            if floor is not None and rest[essential] >= floor:
                essential = len(terms)
            if floor is None:
                scores = query @ postings
                alive = np.flatnonzero(ids != own_id)
                scores = scores[alive]
            else:
                alive = np.flatnonzero(ids != own_id)
                first = terms[:essential]
                scores = (query[first] @ postings[first])[alive]
                # Probe the others while competitive, a few terms at a time.
                at = essential
                while True:
                    competitive = scores + rest[at] >= floor
                    alive, scores = alive[competitive], scores[competitive]
                    if at == len(terms) or not len(alive):
                        break
                    few = terms[at : at + 8]
                    scores = scores + query[few] @ postings[few][:, alive]
                    at += len(few)
            if len(scores) > 4 * k:
                # Everything at least as good as the k-th, ties included.
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                good = scores >= kth
                alive, scores = alive[good], scores[good]
            all_ids = np.concatenate([best_ids, ids[alive]])
            all_scores = np.concatenate([best, scores])
            order = _order(all_scores, all_ids)[:k]
            best_ids, best = all_ids[order], all_scores[order]
        return best_ids, best


def top_k_inner(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` best candidates.

    ``vectors`` has ``vec_id`` and ``vector`` (array of bigint). A cell is one shard and one block
    of queries, so a task's memory is set by the two parameters, whatever the sizes of the tables.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.select(
        "vec_id", "vector", F.size("vector").alias("n"), is_query.alias("is_query")
    )
    counts = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    shards, blocks = parts_for(counts[0], shard_rows), parts_for(counts[1], query_rows)
    deal = F.xxhash64("vec_id", "vector")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    candidates = rows.select(
        F.pmod(deal, F.lit(shards)).cast("int").alias("shard"),
        every_block.alias("query_block"),
        "vec_id",
        "vector",
        "n",
    )
    queries = rows.where("is_query").dropDuplicates(["vec_id", "vector"]).select(
        every_shard.alias("shard"),
        F.pmod(deal, F.lit(blocks)).cast("int").alias("query_block"),
        # New names for Spark, since candidates have the same columns.
        *(F.col(c).alias(c) for c in ("vec_id", "vector", "n")),
    )

    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        for n, own in candidates.groupby("n"):
            wanted = queries[queries["n"] == n]
            if not len(wanted):
                continue
            matrix = np.array(own["vector"].tolist(), np.float64).reshape(len(own), n)
            # Sums of products of such integers are exact in doubles below 2^53, and faster.
            limit = np.abs(matrix).max(initial=0)
            points = np.array(wanted["vector"].tolist(), np.float64).reshape(len(wanted), n)
            exact = limit * np.abs(points).max(initial=0) * max(n, 1) < 2.0**53
            if not exact:
                matrix = np.array(own["vector"].tolist(), np.int64).reshape(len(own), n)
                points = np.array(wanted["vector"].tolist(), np.int64).reshape(len(wanted), n)
            shard = Shard(own["vec_id"].to_numpy(np.int64), matrix)
            floors = wanted["floor"].tolist()
            for query_id, query, floor in zip(wanted["vec_id"], points, floors, strict=True):
                least = None if floor is None or floor != floor or not exact else floor
                ids, scores = shard.search(query_id, query, k, least)
                found.append((np.full(len(ids), query_id), ids, scores.astype(np.int64)))
        columns = zip(*found, strict=True) if found else [[np.empty(0, np.int64)]] * 3
        return pd.DataFrame(
            dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, columns), strict=True))
        )

    def searched(which: Column, queries: DataFrame) -> DataFrame:
        cells = candidates.where(which).groupBy("shard", "query_block")
        asked = queries.where(which).groupBy("shard", "query_block")
        schema = "query_id bigint, vec_id bigint, score bigint"
        return cells.cogroup(asked).applyInPandas(search, schema)

    lists = searched(
        F.col("shard") == 0, queries.withColumn("floor", F.lit(None).cast("double"))
    )
    if shards > 1:
        lists = written(lists, "first-shard")
        full = lists.groupBy(F.col("query_id").alias("vec_id")).agg(
            F.sort_array(F.collect_list("score"), asc=False).alias("scores")
        )
        # Below 2^53 a score is the same as a double.
        floors = full.select("vec_id", F.get("scores", F.lit(k - 1)).cast("double").alias("floor"))
        lists = lists.unionByName(
            searched(F.col("shard") > 0, queries.join(floors, "vec_id", "left"))
        )
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        lists.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

