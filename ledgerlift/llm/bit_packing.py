"""Token ids in files of fixed-width bit packing.

Each id takes the fewest bits that the vocabulary needs. A file's row is a block of whole
documents with its own offsets, so one block can be read alone, and inside it id ``i`` starts at
bit ``i * bits``: any range of ids unpacks with a few numpy operations.

The files are Parquet tables of such blocks, written and read by Spark alone, so they can lie in
any store and appear only when their writer has committed.

Defined cases: a null or empty text has the end id alone; rows with the same ``doc_id`` are
documents of their own, ordered by a hash of their texts and then by these; a null ``doc_id`` comes
first; a very long text is one block; an empty table gives an empty folder of files and no rows;
columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlift.llm.common import text_or_empty
from ledgerlift.llm.word_tokens import ID_TYPE, piece_ids, vocabulary_size

#: A block is closed by the document that brings it to so many ids.
BLOCK_IDS = 1 << 16

BLOCK_SCHEMA = (
    "shard int, block int, bits int, n_ids bigint, "
    "doc_ids array<bigint>, lengths array<bigint>, payload binary"
)


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after another, ``bits`` each, lowest bit first."""
    if bits > 32 or (len(ids) and int(ids.max()) >> bits):
        raise ValueError(f"an id does not fit in {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    parts = []
    # Steps of a multiple of eight ids end at whole bytes.
    for i in range(0, len(ids), 1 << 16):
        few = ids[i : i + (1 << 16)].astype(np.uint32)
        planes = (few[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
        parts.append(np.packbits(planes.astype(np.uint8), axis=None, bitorder="little"))
    return b"".join(p.tobytes() for p in parts)


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from number ``start`` on, without touching the others."""
    if bits in (8, 16, 32):
        kind = np.dtype(f"<u{bits // 8}")
        return np.frombuffer(payload, kind, count, start * kind.itemsize).astype(ID_TYPE)
    first = start * bits // 8
    last = (start + count) * bits // 8 + 1
    raw = np.zeros(last - first + 8, np.uint64)
    found = np.frombuffer(payload, np.uint8)[first:last]
    raw[: len(found)] = found
    position = np.arange(start, start + count, dtype=np.int64) * bits - first * 8
    at, shift = position >> 3, (position & 7).astype(np.uint64)
    window = raw[at]
    for k in range(1, 5):
        window = window | (raw[at + k] << np.uint64(8 * k))
    return ((window >> shift) & np.uint64((1 << bits) - 1)).astype(ID_TYPE)


def _block(shard: int, number: int, bits: int, doc_ids: list, ids: list[bytes]) -> dict:
    everything = np.frombuffer(b"".join(ids), ID_TYPE)
    return {
        "shard": shard,
        "block": number,
        "bits": bits,
        "n_ids": len(everything),
        "doc_ids": doc_ids,
        "lengths": [len(x) // ID_TYPE.itemsize for x in ids],
        "payload": pack(everything, bits),
    }


def write_packed(
    docs: DataFrame, path: str, vocabulary_file: str, end_id: int, block_ids: int = BLOCK_IDS
) -> None:
    """Encode all texts of ``docs`` (``doc_id``, ``text``) and write them to ``path``.

    The documents are dealt out by ranges of ``doc_id``, with the text's hash as the second key
    so that one id that very many rows share, such as null, does not fill one task. Each task
    writes the blocks of one shard; shards, blocks and documents ascend by ``doc_id``.
    """
    bits = bits_for(vocabulary_size(vocabulary_file))
    arrow = pa.schema(
        [
            ("shard", pa.int32()),
            ("block", pa.int32()),
            ("bits", pa.int32()),
            ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("lengths", pa.list_(pa.int64())),
            ("payload", pa.binary()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_ids(vocabulary_file)
        end = np.array([end_id], ID_TYPE).tobytes()
        shard, number = TaskContext.get().partitionId(), 0
        doc_ids, ids, n = [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(shard, number, bits, doc_ids, ids)], arrow)

        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                found = pieces.encode(text) + end
                doc_ids.append(doc_id)
                ids.append(found)
                n += len(found) // ID_TYPE.itemsize
                if n >= block_ids:
                    yield close()
                    number, doc_ids, ids, n = number + 1, [], [], 0
        if doc_ids:
            yield close()

    text = text_or_empty()
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
        .withColumn("_hash", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_hash")
        .sortWithinPartitions("doc_id", "_hash", "text")
        .select("doc_id", F.col("text").cast("binary").alias("text"))
    )
    ordered.mapInArrow(encode, BLOCK_SCHEMA).write.parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files at ``path``, in no order.

    ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (little-endian
    unsigned 32-bit) and ``ids_crc32`` of those bytes.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    in_order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file before it meets in one task.
    shards = (
        blocks.groupBy("shard")
        .agg(F.sum("n_ids").alias("ids_in_shard"))
        .select("shard", F.coalesce(F.sum("ids_in_shard").over(in_order), F.lit(0)).alias("before"))
    )
    # A shard's blocks are few, and only their counts are dealt out.
    in_shard = (
        Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        blocks.select("shard", "block", "n_ids")
        .withColumn("inside", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)))
        .join(shards, "shard")
        .select("shard", "block", (F.col("before") + F.col("inside")).alias("block_start"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                offsets = np.cumsum(lengths) - lengths
                ids = [
                    unpack(row["payload"], row["bits"], int(o), int(n)).tobytes()
                    for o, n in zip(offsets, lengths, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(ids), pa.int32()),
                        pa.array([row["block"]] * len(ids), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    ],
                    names=["shard", "block", "doc_id", "offset", "n_tokens", "ids", "ids_crc32"],
                )

    docs = blocks.mapInArrow(
        decode,
        "shard int, block int, doc_id bigint, offset bigint, n_tokens bigint, "
        "ids binary, ids_crc32 bigint",
    )
    return docs.join(starts, ["shard", "block"]).select(
        "doc_id",
        (F.col("block_start") + F.col("offset")).alias("start"),
        "n_tokens",
        "ids",
        "ids_crc32",
    )
