"""SimHash near-duplicates: fingerprints whose segments' bit counts are joined on a grid.

A fingerprint is cut into 32 segments of two bits, and each segment's number of set bits is one
coordinate: the fingerprint becomes a point of a grid with 32 axes. Changing one bit moves the point
by one step along one axis, so the Manhattan distance of two points is a lower bound of the number
of differing bits. Two points at most two steps apart have a cell at most one step from both.
Each point therefore goes to its own cell and to those one step away (49 on average), a range join
on the grid becomes an equality join on cells, and each pair that meets is verified by its bits.

Narrower segments make a tighter bound but more cells: two random fingerprints are within two steps
with a probability of 2e-11, so even ten billion of them meet only a fraction of one stranger each.
Near copies do crowd in a cell, and their pairs would be a square. A crowded cell is refined to
segments of one bit, where the distance on the grid is the number of differing bits: fingerprints
at most two bits apart share a one-bit variant, and all that share one are linked with the least of
them. So every link is found, or both its ends are linked with a third fingerprint; components are
exact, and the work is linear in the fingerprints.

Only distinct fingerprints are joined, each with its least ``doc_id`` and its number of documents;
a fingerprint of very many documents is one row. Documents get their component by a join that
broadcasts the most frequent fingerprints, of which there can be only a thousand.

Defined cases: words are split at ASCII white space with A-Z lower-cased; a null or empty text, or
one of white space, has fingerprint zero and is linked like any other; a text of fewer words than a
shingle is one shingle; a very long text is read in slices, so its words are never all in memory;
repeated rows and rows that share an id are documents of their own; a null id takes the least id of
its component, if there is one; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import join_by_frequency, text_or_empty, words_by_slice, written
from ledgerlift.llm.components import connected_components

#: Bits that two linked fingerprints differ in at most. The join by one-step cells is for two.
MAX_BITS = 2
#: Fingerprints from which a cell is refined: as many pairs as it then has one-bit variants.
CROWD = 65
#: Bytes of a text that are cut into words at once.
SLICE = 1 << 18

_SEED = 42
_EVEN_BITS = 0x5555555555555555
# Bits set in each byte value, by bit.
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def _votes(words: list[bytes], n: int) -> np.ndarray:
    """How many hashes of the words' n-word shingles have each bit set."""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], _SEED) for s, e in zip(starts, ends[n - 1 :].tolist(), strict=True)),
        np.uint64,
        len(starts),
    )
    by_byte = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = [np.bincount(by_byte[:, k], minlength=256) @ _BITS_OF_BYTE for k in range(8)]
    return np.concatenate(counts)


def fingerprint(text: bytes, n: int = 3) -> int:
    """The majority of the shingles' hashes in each bit, as an unsigned integer."""
    votes, total, carried = np.zeros(64, np.int64), 0, []
    for words in words_by_slice(text, SLICE):
        words = carried + words
        if len(words) >= n:
            votes += _votes(words, n)
            total += len(words) - n + 1
            carried = words[len(words) - n + 1 :]
        else:
            carried = words
    if not total and carried:
        votes, total = _votes(carried, len(carried)), 1
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (signed 64 bits) of each document (``doc_id``, ``text``)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), n) for t in batch.column("text")]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fingerprint"]
            )

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text")
    )
    return texts.mapInArrow(digest, "doc_id bigint, fingerprint bigint")


def segment_counts(fingerprint: Column) -> Column:
    """Set bits of each two-bit segment, two bits a count: the point on the grid."""
    low = fingerprint.bitwiseAND(F.lit(_EVEN_BITS))
    high = F.shiftrightunsigned(fingerprint, 1).bitwiseAND(F.lit(_EVEN_BITS))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _cells(fingerprints: DataFrame) -> DataFrame:
    """Each fingerprint with its point's cell and those one step away.

    A count goes between 0 and 1 by flipping its lower bit, and between 1 and 2 by flipping both.
    """
    step = F.col("step")
    segment = 2 * F.floor(step / 2).cast("int")
    both = step % 2 == 1
    point = segment_counts(F.col("fingerprint"))
    count = F.expr("shiftrightunsigned(point, segment)").bitwiseAND(F.lit(3).cast("bigint"))
    flips = F.expr("shiftleft(CAST(IF(step % 2 = 1, 3, 1) AS BIGINT), segment)")
    steps = (
        fingerprints.select("fingerprint", point.alias("point"))
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(64))))
        .withColumn("segment", segment)
        .withColumn("count", count)
    )
    possible = (step == 64) | F.when(both, F.col("count") != 0).otherwise(F.col("count") != 2)
    cell = F.when(step == 64, F.col("point")).otherwise(F.col("point").bitwiseXOR(flips))
    return steps.where(possible).select("fingerprint", cell.alias("cell"))


def _verified(cells: DataFrame) -> DataFrame:
    """Pairs that share a cell and differ in few enough bits."""
    x, y = cells.alias("x"), cells.alias("y")
    a, b = F.col("x.fingerprint"), F.col("y.fingerprint")
    near = (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS)
    met = x.join(y, (F.col("x.cell") == F.col("y.cell")) & near)
    return met.select(a.alias("a"), b.alias("b")).distinct()


def _by_variant(crowded: DataFrame) -> DataFrame:
    """Links of each fingerprint with the least that has the same one-bit variant."""
    flip = F.expr("IF(bit = 64, 0L, shiftleft(1L, bit))")
    variants = (
        crowded.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit"))
        .select("fingerprint", F.col("fingerprint").bitwiseXOR(flip).alias("variant"))
    )
    least = variants.groupBy("variant").agg(
        F.min("fingerprint").alias("a"), F.count(F.lit(1)).alias("n")
    )
    shared = least.where("n > 1").drop("n")
    pairs = variants.join(shared, "variant").select("a", F.col("fingerprint").alias("b"))
    return pairs.where("a <> b").distinct()


def fingerprint_links(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints at most two bits apart, and no others.

    ``distinct`` has each ``fingerprint`` once. In cells of up to ``crowd`` fingerprints each pair is
    verified; those of crowded cells are linked through their one-bit variants.
    """
    cells = _cells(distinct)
    several = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(cells.join(several, "cell"), "shared-cells")
    pairs = _verified(shared.where(F.col("n") <= crowd).select("fingerprint", "cell"))
    crowded = shared.where(F.col("n") > crowd).select("fingerprint").distinct()
    return pairs.unionByName(_by_variant(crowded))


def simhash_components(docs: DataFrame, n: int = 3, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of each document.

    ``component_id`` is the smallest ``doc_id`` reachable by links, the document's own included.
    """
    marked = written(fingerprints(docs, n), "fingerprints")
    distinct = written(
        marked.groupBy("fingerprint").agg(
            F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_docs")
        ),
        "distinct-fingerprints",
    )
    links = fingerprint_links(distinct.select("fingerprint"), crowd)
    components = connected_components(links).withColumnRenamed("node", "fingerprint")
    rooted = written(
        distinct.join(components, "fingerprint", "left").withColumn(
            "root", F.coalesce("root", "fingerprint")
        ),
        "rooted",
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fingerprint", "n_docs", "component_id")
    labelled = join_by_frequency(marked, written(labels, "labels"), "fingerprint", "n_docs")
    return labelled.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
