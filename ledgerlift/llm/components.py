"""Connected components of links between ids, by large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import written

#: Edges that one task finishes: rounds over so few cost far more than the work in them.
FEW_EDGES = 20_000


def _digest(edges: DataFrame) -> tuple:
    """Count and sum of hashes: equal for equal sets of edges, in any order."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the least among the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        around.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def _finished(edges: DataFrame) -> DataFrame:
    """Each node's root, by union-find over at most ``FEW_EDGES`` edges."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while x != top:
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            for u, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low, high = sorted((root(u), root(v)))
                parent[high] = low
        columns = [pa.array(list(parent), pa.int64()), pa.array(map(root, list(parent)), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "root"])

    return edges.select("u", "v").coalesce(1).mapInArrow(unite, "node bigint, root bigint")


def connected_components(links: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node of ``links`` (``a``, ``b``).

    Up to ``few`` edges are finished by one task, more of them by rounds. The rounds grow with the logarithm of a component's width, and after each the edges are
    written, so that a lost executor costs one round at most. Every grouping is a minimum, made
    before the shuffle; a node of very many links is a skewed join key, which adaptive execution
    splits.
    """
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = written(edges, "edges")
    before = _digest(edges)
    if before[0] <= few:
        return _finished(edges)
    while True:
        edges = written(_small_star(written(_large_star(edges), "large-star")), "small-star")
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
