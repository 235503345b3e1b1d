"""Documents packed into training sequences of a fixed number of tokens.

Only the lengths matter to the packing, and there are no more lengths than tokens in a sequence,
so the plan is made on a histogram of that fixed size, whatever the number of documents. First
come Martello and Toth's dominance reductions: a set that holds the longest piece and dominates
every other set that could hold it is fixed for good. Best fit packs what is left. The plan says
which ranks of which length go to which sequences; each piece finds its place by its rank.

Defined cases: a null or empty text is a document of the end id alone; repeated rows are packed
as often as they come; null ids are kept; an empty table gives no rows; columns other than id and
text are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import text_or_empty, written
from ledgerlift.llm.word_tokens import ID_TYPE, MAX_PIECES, piece_ids


class Pattern(NamedTuple):
    """``bins`` sequences that each hold ``(length, how many)`` of ``items``."""

    items: tuple[tuple[int, int], ...]
    bins: int


def _largest(counts: np.ndarray, limit: int) -> int:
    """The largest length up to ``limit`` that is left; 0 if none."""
    found = np.flatnonzero(counts[1 : limit + 1])
    return int(found[-1]) + 1 if len(found) else 0


def _best_pair(counts: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths with the largest sum up to ``room``; zeros if none fit."""
    there = np.flatnonzero(counts[: room + 1])
    if not len(there):
        return 0, 0
    upper = np.searchsorted(there, room - there, side="right") - 1
    other = np.where(upper >= 0, there[np.maximum(upper, 0)], 0)
    # A length goes with itself only if two are left; else with the next shorter one.
    alone = (other == there) & (counts[there] < 2)
    shorter = np.where(upper >= 1, there[np.maximum(upper - 1, 0)], 0)
    other = np.where(alone, shorter, other)
    total = np.where(other > 0, there + other, 0)
    best = int(np.argmax(total))
    return (int(there[best]), int(other[best])) if total[best] else (0, 0)


def _fix(counts: np.ndarray, lengths: list[int]) -> Pattern:
    """As many sequences of these lengths as the counts allow, taken from the counts."""
    each = defaultdict(int)
    for length in lengths:
        each[length] += 1
    bins = int(min(counts[length] // k for length, k in each.items()))
    for length, k in each.items():
        counts[length] -= bins * k
    return Pattern(tuple(sorted(each.items(), reverse=True)), bins)


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Fix the sets that dominate all others with the same longest piece; lowers ``counts``.

    With the longest piece ``l`` and room ``r`` beside it, the set of ``l`` alone dominates if
    nothing fits; the pair with the longest fitting piece ``j`` does if it fills the sequence, or
    if no two pieces that fit together are longer than ``j`` and no three fit.
    """
    fixed, changed = [], True
    while changed:
        changed = False
        for length in range(capacity, 0, -1):
            while counts[length]:
                counts[length] -= 1
                room = capacity - length
                partner = _largest(counts, room)
                smallest = int(np.argmax(counts > 0)) if partner else 0
                dominates = (
                    not partner
                    or partner == room
                    or (partner >= sum(_best_pair(counts, room)) and 3 * smallest > room)
                )
                counts[length] += 1
                if not dominates:
                    break
                fixed.append(_fix(counts, [length, partner] if partner else [length]))
                changed = True
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Fill sequence after sequence, longest piece first, with what leaves the least room."""
    patterns = []
    while (length := _largest(counts, capacity)) > 0:
        chosen, left = [length], counts.copy()
        left[length] -= 1
        room = capacity - length
        while (one := _largest(left, room)) > 0:
            pair = _best_pair(left, room) if one < room else (0, 0)
            # Two together are better than one if they leave less room than one can, with
            # nothing that fits beside it.
            rest = left.copy()
            rest[one] -= 1
            take = list(pair) if sum(pair) > one + _largest(rest, room - one) else [one]
            chosen += take
            for x in take:
                left[x] -= 1
            room -= sum(take)
        patterns.append(_fix(counts, chosen))
    return patterns


def plan_packing(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every piece of the histogram once."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    return reduce_by_dominance(counts, capacity) + best_fit(counts, capacity)


class Places:
    """Where the piece of some rank among those of its length goes."""

    def __init__(self, patterns: list[Pattern]):
        taken, rows, sequence = defaultdict(int), [], 0
        for items, bins in patterns:
            offset = 0
            for length, k in items:
                rows.append((length, taken[length], k, sequence, offset))
                taken[length] += bins * k
                offset += length * k
            sequence += bins
        self.rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.sequences = sequence

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
        first = np.searchsorted(self.rows[:, 0], length, side="left")
        last = np.searchsorted(self.rows[:, 0], length, side="right")
        for low, high in {*zip(first.tolist(), last.tolist(), strict=True)}:
            mine = first == low
            slots = self.rows[low:high]
            slot = slots[np.searchsorted(slots[:, 1], rank[mine], side="right") - 1]
            nth = rank[mine] - slot[:, 1]
            sequence[mine] = slot[:, 3] + nth // slot[:, 2]
            offset[mine] = slot[:, 4] + nth % slot[:, 2] * slot[:, 0]
        return sequence, offset


PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, "
    "part int, nth bigint"
)


def cut_pieces(
    docs: DataFrame,
    vocabulary_file: str,
    end_id: int,
    capacity: int,
    keep_ids: bool = False,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Encode each text, add the end id, and cut what is longer than ``capacity``.

    ``part`` and ``nth`` number the pieces of one length within the task that made them.
    """
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.binary()),
            ("part", pa.int32()),
            ("nth", pa.int64()),
        ]
    )
    size = ID_TYPE.itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part = piece_ids(vocabulary_file, max_pieces), TaskContext.get().partitionId()
        end = np.array([end_id], ID_TYPE).tobytes()
        seen = defaultdict(int)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch[0], batch[1], strict=True):
                doc_id, ids = doc_id.as_py(), pieces.encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), capacity * size)):
                    own = ids[at : at + capacity * size]
                    length = len(own) // size
                    kept = own if keep_ids else None
                    crc = zlib.crc32(own)
                    rows.append(
                        (doc_id, piece, at // size, length, crc, kept, part, seen[length])
                    )
                    seen[length] += 1
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)],
                    schema=arrow,
                )

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text")
    )
    return texts.mapInArrow(cut, PIECES)


def pack_documents(
    docs: DataFrame,
    vocabulary_file: str,
    end_id: int,
    capacity: int = 2048,
    keep_ids: bool = False,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and its ``offset`` there.

    The pieces are written once, so that their numbers stay as they are. To the driver go the
    counts of the ``capacity`` lengths at most; the tasks get the plan made of them, whose size
    depends on ``capacity`` alone. ``max_pieces`` bounds a worker's cache of encoded words.
    """
    cut = cut_pieces(docs, vocabulary_file, end_id, capacity, keep_ids, max_pieces)
    pieces = written(cut, "pieces")
    # What a task has of one length follows what the tasks before it have.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    ranks = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    places = Places(plan_packing({r.length: r.n for r in lengths}, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            sequence, offset = places.find(length, batch.column("rank").to_numpy())
            kept = batch.select(out_columns)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)],
                names=[*out_columns, "sequence_id", "offset"],
            )

    out_columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    ranked = pieces.join(ranks, ["part", "length"]).select(
        *out_columns, (F.col("before") + F.col("nth")).alias("rank")
    )
    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with their ids: a row for each.

    A group has at most ``capacity`` tokens, so none is large.
    """
    in_place = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(in_place.alias("pieces")).select(
        "sequence_id",
        F.col("pieces.doc_id").alias("doc_ids"),
        F.col("pieces.length").alias("lengths"),
        F.expr("aggregate(pieces.ids, cast('' as binary), (a, x) -> a || x)").alias("ids"),
    )
