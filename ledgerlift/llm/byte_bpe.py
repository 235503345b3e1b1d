"""Byte-level BPE with a file of merge ranks, both ways.

Distinct pieces of text are encoded together: those of similar length fill a padded numpy matrix,
one row each, and every round each row merges its leftmost pair of the lowest rank. Pairs are
looked up in an open-addressed hash table; rows that are done leave the matrix and it narrows as
its rows do. Pieces longer than the widest matrix are merged one by one with a heap, in
``n log n`` steps. Both give what the reference library gives for the same ranks.

Defined cases: a null or empty text has no ids and decodes to nothing; strings of special tokens
are ordinary text; repeated rows and null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import text_or_empty

ID_TYPE = np.dtype("<u4")
NO_RANK = np.int32(2**31 - 1)
#: Widths of the matrices; a piece goes to the narrowest that holds its bytes.
WIDTHS = (4, 6, 8, 12, 16, 24, 32, 64, 128, 256)
#: Rows of a matrix at most, so that one round's tables stay small.
MATRIX_ROWS = 1 << 15


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Ids of two neighbours to the id of both together, vectorised."""

    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        keys = np.array([key for key, _ in pairs], np.uint64)
        values = np.array([rank for _, rank in pairs], np.int32)
        size_bits = max(4, int(np.ceil(np.log2(2 * len(pairs) + 1))))
        self.shift = np.uint64(64 - size_bits)
        self.last = np.int64((1 << size_bits) - 1)
        self.keys = np.full(1 << size_bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << size_bits, NO_RANK)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == np.uint64(2**64 - 1)
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slots = (slots[~placed] + 1) & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.MIX) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NO_RANK`` where there is none or an id is negative."""
        found = np.full(left.shape, NO_RANK)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[todo].astype(np.uint64) << np.uint64(32) | right[todo].astype(np.uint64)
        slots = self._slots(keys)
        while len(todo):
            there = self.keys[slots]
            hit = there == keys
            found[todo[hit]] = self.values[slots[hit]]
            more = ~hit & (there != np.uint64(2**64 - 1))
            todo, keys, slots = todo[more], keys[more], (slots[more] + 1) & self.last
        return found


class ByteBpe:
    """Encoder and decoder for one file of ranks and one splitting pattern.

    The ids of up to ``max_pieces`` short pieces are kept from text to text.
    """

    def __init__(self, ranks_file: str, pattern: str, max_pieces: int = 400_000):
        self.ranks = read_ranks(ranks_file)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.table = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.split = regex.compile(pattern).findall
        self.max_pieces = max_pieces
        self.known: dict[str, bytes] = {}
        self.decimal: dict[str, bytes] = {}

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of pieces of up to ``width`` bytes."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        n = np.array([len(p) for p in pieces], np.int64)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = self.byte_ids[raw.reshape(-1, width)]
        ids[np.arange(width) >= n[:, None]] = -1
        ranks = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        row = np.arange(len(ids))
        while len(row):
            at = ranks.argmin(axis=1)
            lines = np.arange(len(row))
            best = ranks[lines, at]
            done = best == NO_RANK
            if done.any():
                for k in np.flatnonzero(done):
                    out[row[k]] = ids[k, : n[row[k]]].copy()
                keep = ~done
                row, ids, ranks, at, best = row[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not len(row):
                    break
                lines = np.arange(len(row))
            # The merged id takes the left place; all beyond the right one move up.
            n[row] -= 1
            room = max(int(n[row].max()), 1)
            moved = np.arange(ids.shape[1] - 1) > at[:, None]
            ids = np.where(moved, ids[:, 1:], ids[:, :-1])
            ids[lines, at] = best
            pad = np.full((len(row), 1), NO_RANK)
            ranks = np.concatenate([ranks, pad], axis=1)
            ranks = np.where(np.arange(ids.shape[1]) > at[:, None], ranks[:, 1:], ranks[:, :-1])
            ids = np.concatenate([ids, np.full((len(row), 1), -1, np.int32)], axis=1)
            ranks[lines, at] = self.table.find(ids[lines, at], ids[lines, at + 1])
            before = np.flatnonzero(at > 0)
            left = at[before] - 1
            ranks[before, left] = self.table.find(ids[before, left], ids[before, left + 1])
            ids, ranks = ids[:, : room + 1], ranks[:, :room]
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        """Ids of one piece of any length, with a heap of its pairs."""
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = [
            (rank, i, 2)
            for i in range(len(parts) - 1)
            if (rank := self.ranks.get(piece[i : i + 2])) is not None
        ]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(parts):
                both = parts[i] + parts[after[i]]
                if (rank := self.ranks.get(both)) is not None:
                    heapq.heappush(heap, (rank, i, len(both)))

        while heap:
            rank, i, size = heapq.heappop(heap)
            j = after[i]
            # A pair counts only if both sides are still as they were offered.
            if parts[i] is None or j >= len(parts) or self.ranks.get(parts[i] + parts[j]) != rank:
                continue
            if len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([self.ranks[p] for p in parts if p is not None], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; a piece that is a token is that token."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[k] = np.array([rank], np.int32)
            elif len(piece) > WIDTHS[-1]:
                out[k] = self._long(piece)
            else:
                width = next(w for w in WIDTHS if w >= len(piece))
                buckets.setdefault(width, []).append(k)
        for width, members in buckets.items():
            for i in range(0, len(members), MATRIX_ROWS):
                few = members[i : i + MATRIX_ROWS]
                found = self._matrix([pieces[k] for k in few], width)
                for k, ids in zip(few, found, strict=True):
                    out[k] = ids
        return out

    def _learn(self, pieces: Iterable[str]) -> None:
        new = list(pieces)
        for piece, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            self.known[piece] = ids.astype(ID_TYPE).tobytes()
            self.decimal[piece] = b"".join(b"%d," % i for i in ids.tolist())

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids, as little-endian unsigned 32-bit integers and in decimals
        joined by commas."""
        if len(self.known) > self.max_pieces:
            self.known.clear()
            self.decimal.clear()
        split = [self.split(text) for text in texts]
        new = set().union(*split).difference(self.known) if split else set()
        self._learn(new)
        for pieces in split:
            ids = b"".join(map(self.known.__getitem__, pieces))
            yield ids, b"".join(map(self.decimal.__getitem__, pieces))[:-1]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, ID_TYPE).tolist()))


@lru_cache(maxsize=2)
def codec(ranks_file: str, pattern: str) -> ByteBpe:
    """The codec of this worker process, kept from task to task."""
    return ByteBpe(ranks_file, pattern)


def encode_documents(
    docs: DataFrame, ranks_file: str, pattern: str, texts_at_once: int = 200
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of every text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_file, pattern)
        for batch in _few(batches, texts_at_once):
            ids = [found for found, _ in own.encode_batch(batch[1].to_pylist())]
            counts = [len(x) // ID_TYPE.itemsize for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return _texts(docs).mapInArrow(encode, "doc_id bigint, n_tokens bigint, ids binary")


def decode_documents(encoded: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """``doc_id`` and the ``decoded`` bytes of rows with ``doc_id`` and ``ids``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_file, pattern)
        for batch in batches:
            texts = [own.decode(ids) for ids in batch[1].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(texts, pa.binary())], names=["doc_id", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, decoded binary")


def round_trip_digests(
    docs: DataFrame, ranks_file: str, pattern: str, texts_at_once: int = 200
) -> DataFrame:
    """Encode every text, decode the ids, and return digests of both.

    As :func:`encode_documents` and :func:`decode_documents` in one pass, without moving the ids.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_file, pattern)
        for batch in _few(batches, texts_at_once):
            counts, of_ids, of_texts = [], [], []
            for ids, decimal in own.encode_batch(batch[1].to_pylist()):
                counts.append(len(ids) // ID_TYPE.itemsize)
                of_ids.append(hashlib.sha256(decimal).hexdigest())
                of_texts.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_texts)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _texts(docs).mapInArrow(
        digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")
    )


def _few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that the split texts of one fit in memory."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
