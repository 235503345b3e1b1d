"""Merkle manifest of a dataset: a tree per language, one over their roots, and a proof per leaf.

A node carries the interval of leaf ranks that it covers. Its parent is the node of the next level
whose interval contains its own, and what the parent's interval has beyond it is the sibling's, so
ancestors and siblings follow from intervals alone.

Levels are bucketed: twelve of them are computed at once, in a task that has the at most 4096 nodes
of the lowest of them that one node of the highest covers. Going up, each bucket leaves one row, its
top node, for the next bucket of levels, so a table shrinks by 4096 from one to the next. Going
down, nodes are joined with the top node that contains them, which brings the path from there to the
root; inside, each level's siblings are what their parents' intervals leave. The tree over the
languages' roots is made by the same two steps.

Ranks come from a range sort and the counts of its ranges, so the largest language is dealt over all
tasks, and no window or group is larger than a bucket. A proof is a hash here, but
:func:`merkle_nodes` and :func:`merkle_proofs` return what a manifest needs: nodes and whole paths.

Defined cases: a null in any column is hashed as ``-``; a null language is a tree of its own and comes
first; null ids come first in their tree; rows with one id are ordered by their hash; equal rows are
leaves of their own; very long texts are hashed by Spark where they are; a null id is never tampered
with, and a null ``n_chars`` stays null; a tree of one leaf is that leaf; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlift.llm.common import written

#: Levels that one task computes at once.
LEVELS = 12

# The columns of a leaf in the order in which they are hashed.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

#: Columns of a node: its tree, the level and the leaf ranks it covers, from ``low`` up to ``high``.
NODE = "tree string, level int, low bigint, high bigint, leaves bigint, hash string"


def _field(column: Column) -> Column:
    text = column.cast("string")
    size = F.octet_length(text).cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(size, F.lit(":"), text))


def leaf_hash(**columns: Column) -> Column:
    """SHA-256 of a row's columns; ``columns`` replaces some."""
    fields = [_field(columns.get(c, F.col(c))) for c in LEAF_COLUMNS]
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def _joined(hashes: list[str]) -> str:
    return sha256("".join(hashes).encode()).hexdigest()


def _up(hashes: list[str], low: int, high: int, level: int, more: int) -> Iterator[list[tuple]]:
    """Each level's nodes ``(low, high, hash)`` over leaf ranks ``low`` up to ``high``, upwards.

    ``hashes`` are the nodes of ``level``, in order. It ends ``more`` levels above, or with the root.
    """
    width = 1 << level
    nodes = [
        (start, min(start + width, high), h)
        for start, h in zip(range(low, high, width), hashes, strict=True)
    ]
    yield nodes
    for _ in range(more):
        if low == 0 and high <= width:  # the whole tree
            return
        runs = [nodes[k : k + 2] for k in range(0, len(nodes), 2)]
        nodes = [(run[0][0], run[-1][1], _joined([h for *_, h in run])) for run in runs]
        width *= 2
        yield nodes


def siblings(level: list[tuple], above: list[tuple]) -> list[str]:
    """What each node's parent has beyond the node's interval: ``L`` or ``R`` for its side and its
    hash, or ``-`` if nothing is left."""
    starts = {low: h for low, _, h in level}
    ends = {high: h for _, high, h in level}
    found, parents = [], iter(above)
    parent_low, parent_high, _ = next(parents)
    for low, high, _ in level:
        if low >= parent_high:
            parent_low, parent_high, _ = next(parents)
        if parent_low < low:
            found.append("L" + ends[low])
        elif high < parent_high:
            found.append("R" + starts[high])
        else:
            found.append("-")
    return found


def proof_hashes(path: str) -> list[str]:
    """The siblings' hashes on a path, lowest first."""
    return [path[k + 1 : k + 65] for k in _steps(path) if path[k] != "-"]


def _steps(path: str) -> Iterator[int]:
    at = 0
    while at < len(path):
        yield at
        at += 1 if path[at] == "-" else 65


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the siblings on its path lead to."""
    for k in _steps(path):
        other = path[k + 1 : k + 65]
        leaf = _joined({"L": [other, leaf], "R": [leaf, other], "-": [leaf]}[path[k]])
    return leaf


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (a written table with a column ``tree``) with their ``low`` in their tree, and how
    many ``leaves`` it has. Equal rows come in any order."""
    # Range partitions cannot split rows that are equal in all of the order.
    dealt = rows.withColumn("_any", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange("tree", *order, "_any")
    in_order = dealt.sortWithinPartitions("tree", *order, "_any").drop("_any")
    schema = StructType([*rows.schema, *StructType.fromDDL("part int, place bigint")])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for name in batch.column("tree").to_pylist():
                tree, at = (tree, at + 1) if name == tree else (name, 0)
                places.append(at)
            extra = [pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *extra], names=[*batch.schema.names, "part", "place"]
            )

    numbered = written(in_order.mapInArrow(number, schema), "numbered")
    counts = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each range of a tree.
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree",
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(tree).alias("leaves"),
    )
    return (
        numbered.join(offsets, ["tree", "part"])
        .withColumn("low", F.col("place") + F.col("before"))
        .drop("part", "place", "before")
    )


def _bucket(level: int) -> Column:
    """Number of the top node, ``LEVELS`` above ``level``, that contains a node."""
    return F.shiftright("low", level + LEVELS).alias("bucket")


def _top_nodes(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes ``LEVELS`` above those of ``level``, or the roots of the trees that end before."""

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("low")
        first = pdf.iloc[0]
        *_, last = _up(pdf["hash"].tolist(), int(pdf["low"].min()), int(pdf["high"].max()), level, LEVELS)
        ((low, high, found),) = last
        row = (first["tree"], level + LEVELS, low, high, first["leaves"], found)
        return pd.DataFrame([row], columns=["tree", "level", "low", "high", "leaves", "hash"])

    return nodes.groupBy("tree", _bucket(level)).applyInPandas(top, NODE)


def merkle_nodes(leaves: DataFrame) -> list[DataFrame]:
    """Written tables of the nodes at each ``LEVELS``-th level of the trees over ``leaves``
    (``tree``, ``low``, ``leaves``, ``hash``), the leaves first, the roots last."""
    nodes = leaves.select(
        "tree",
        F.lit(0).alias("level"),
        "low",
        (F.col("low") + 1).alias("high"),
        "leaves",
        "hash",
    )
    levels, level = [nodes], 0
    longest = leaves.agg(F.max("leaves")).first()[0] or 0
    while longest > 1 << level:
        levels.append(written(_top_nodes(levels[-1], level), "nodes"))
        level += LEVELS
    return levels


def _down(nodes: DataFrame, tops: DataFrame, level: int, finish, schema: str) -> DataFrame:
    """Joins the nodes of ``level`` with the top node whose interval contains them.

    ``finish`` makes the rows of ``schema`` from a group's nodes, their paths to the root and the root
    of their tree, both of which go on from the top node's ``path`` and ``subroot``.
    """

    def attach(inside: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        inside = inside.sort_values("low", kind="stable").reset_index(drop=True)
        low, high = int(inside["low"].min()), int(inside["high"].max())
        top = top.iloc[0]
        if not top["low"] <= low < high <= top["high"]:
            raise ValueError(f"{low} to {high} is outside {top['low']} to {top['high']}")
        levels = list(_up(inside["hash"].tolist(), low, high, level, LEVELS))
        steps = [siblings(x, above) for x, above in zip(levels, levels[1:], strict=False)]
        paths = [
            "".join(s[i >> k] for k, s in enumerate(steps)) + top["path"] for i in range(len(inside))
        ]
        return finish(inside, paths, top["subroot"])

    groups = nodes.groupBy("tree", _bucket(level))
    return groups.cogroup(tops.groupBy("tree", _bucket(level))).applyInPandas(attach, schema)


def merkle_proofs(levels: list[DataFrame], roots: DataFrame, finish, schema: str) -> DataFrame:
    """Rows that ``finish`` makes from each leaf, its path to the root and the root of its tree.

    ``levels`` are those of :func:`merkle_nodes`, where the leaves may have columns of their own;
    ``roots`` has the ``path`` that goes on above each ``tree``, and its ``subroot``.
    """

    def named(inside: pd.DataFrame, paths: list[str], subroot: str) -> pd.DataFrame:
        return inside[["tree", "low", "high"]].assign(path=paths, subroot=subroot)

    def alone(pdf: pd.DataFrame) -> pd.DataFrame:
        return finish(pdf, pdf["path"].tolist(), pdf["subroot"].iloc[0])

    above = levels[-1].join(roots, "tree")
    if len(levels) == 1:  # every tree is one leaf
        return above.groupBy("tree").applyInPandas(alone, schema)
    passed = "tree string, low bigint, high bigint, path string, subroot string"
    for k in reversed(range(1, len(levels) - 1)):
        above = written(_down(levels[k], above, LEVELS * k, named, passed), "paths")
    return _down(levels[0], above, 0, finish, schema)


def merkle_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``
    of each document.

    Rows for which ``tampered`` holds are verified with an ``n_chars`` one larger than the manifest's.
    """
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    # Null before every language, and bytewise as strings are.
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang")))
    hashed = written(
        docs.select(
            tree.alias("tree"),
            "doc_id",
            leaf_hash().alias("hash"),
            F.when(changed, leaf_hash(n_chars=one_more)).alias("tampered_leaf"),
        ),
        "leaves",
    )
    leaves = written(_ranked(hashed, "doc_id", "hash"), "ranked")
    levels = merkle_nodes(leaves)
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "hash")
    languages = written(_ranked(written(subroots, "subroots"), "lang"), "languages")
    top_levels = merkle_nodes(languages)
    root = top_levels[-1].select("tree", "hash")

    def to_root(inside: pd.DataFrame, paths: list[str], _: str) -> pd.DataFrame:
        return pd.DataFrame({"tree": inside["lang"], "path": paths, "subroot": inside["hash"]})

    high = (F.col("low") + 1).alias("high")
    top = root.select("tree", F.lit("").alias("path"), F.lit("").alias("subroot"))
    named = languages.select("tree", "low", high, "lang", "hash")
    above = written(
        merkle_proofs(
            [named, *top_levels[1:]], top, to_root, "tree string, path string, subroot string"
        ),
        "language-paths",
    )

    def verify(inside: pd.DataFrame, paths: list[str], subroot: str) -> pd.DataFrame:
        shown = inside["tampered_leaf"].fillna(inside["hash"])
        return pd.DataFrame(
            {
                "doc_id": inside["id_text"],
                "leaf": inside["hash"],
                "subroot": subroot,
                "proof_sha256": [_joined(proof_hashes(p)) for p in paths],
                "folded_root": [fold(h, p) for h, p in zip(shown, paths, strict=True)],
            }
        )

    # As text, since pandas would make floating-point numbers of ids with a null among them.
    id_text = F.col("doc_id").cast("string").alias("id_text")
    with_ids = leaves.select("tree", "low", high, id_text, "hash", "tampered_leaf")
    proofs = merkle_proofs(
        [with_ids, *levels[1:]],
        above,
        verify,
        "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string",
    )
    return proofs.withColumn("root", root.select("hash").scalar()).select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
