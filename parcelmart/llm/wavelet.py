"""Token ids in succinct files: one wavelet matrix per shard, answering access, rank, select and count by itself.

A shard holds the ids of consecutive documents. Its ids are split into bit planes, highest bit first; each plane
stores its bits in an order in which, plane after plane, ids with a 0 go before ids with a 1. One number for each
block of 4,096 bits counts the ones before it, so that a position is followed through all planes without unpacking
them. The file is a header, the planes' numbers of zeros, the block counts and the planes, deflated where that helps.

Documents are range-partitioned by ``doc_id`` and sorted, so that shards follow each other in id order. Shards are
rows of a Parquet table (``part``, ``shard``, ``local_start`` and the file's bytes), written by Spark's writer: a lost
executor's shards are written anew, and no shard is larger than ``SHARD_IDS`` ids plus one document.

Defined results: a null or empty text is the end id alone; rows that share a ``doc_id`` follow each other, by text within a partition;
null ids come first; an empty table gives no shards. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.tokens import encoder

MAGIC = b"WMX1"
HEADER = struct.Struct("<4sBBHQ")
BLOCK = 4096
SHARD_IDS = 1 << 18
END_ID = 0


def encode(ids: np.ndarray, bits: int | None = None) -> bytes:
    """The file of one shard. ``bits``: planes, by default as many as the largest id needs."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    bits = bits or max(1, int(ids.max(initial=0)).bit_length())
    order = ids.astype(np.uint16) if bits <= 16 else ids
    zeros, counts, planes = [], [], []
    for plane in range(bits - 1, -1, -1):
        ones = (order & order.dtype.type(1 << plane)).astype(bool)
        # By positions: numpy copies these several times faster than by a mask.
        below, above = order.take(np.flatnonzero(~ones)), order.take(np.flatnonzero(ones))
        zeros.append(len(below))
        packed = np.packbits(ones)
        # Whole blocks only: the ones of the last block stand before no other.
        whole = np.bitwise_count(packed[: len(ones) // BLOCK * (BLOCK // 8)].view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
        counts.append(np.concatenate(([0], np.cumsum(whole)))[: -(-len(ones) // BLOCK)].astype("<u4"))
        raw = packed.tobytes()
        # The upper planes are long runs of equal bits; the lower ones look random and stay as they are.
        share = len(below) / max(1, len(ones))
        small = zlib.compress(raw, 1) if min(share, 1 - share) < 0.15 else raw
        planes.append((1, small) if len(small) < len(raw) else (0, raw))
        order = np.concatenate((below, above))
    body = [HEADER.pack(MAGIC, bits, 0, 0, len(ids)), np.array(zeros, "<u8").tobytes()]
    for (packed, data), count in zip(planes, counts, strict=True):
        body += [struct.pack("<BQ", packed, len(data)), np.asarray(count, "<u4").tobytes(), data]
    return b"".join(body)


class WaveletMatrix:
    """A shard read from its file."""

    def __init__(self, data: bytes):
        magic, self.bits, _, _, self.size = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        at = HEADER.size
        self.zeros = np.frombuffer(data, "<u8", self.bits, at).astype(np.int64)
        at += 8 * self.bits
        blocks = -(-self.size // BLOCK)
        self.counts, self.planes = [], []
        for _ in range(self.bits):
            packed, length = struct.unpack_from("<BQ", data, at)
            at += 9
            self.counts.append(np.frombuffer(data, "<u4", blocks, at))
            at += 4 * blocks
            raw = data[at : at + length]
            self.planes.append(np.frombuffer(zlib.decompress(raw) if packed else raw, np.uint8))
            at += length

    def __len__(self) -> int:
        return self.size

    def _ones(self, plane: int, at: int) -> int:
        """Ones before position ``at`` of a plane."""
        if at <= 0 or not self.size:
            return 0
        block = min(at, self.size - 1) // BLOCK
        bits = self.planes[plane][block * BLOCK // 8 : (at + 7) // 8]
        tail = np.unpackbits(bits, count=at - block * BLOCK) if at > block * BLOCK else bits[:0]
        return int(self.counts[plane][block]) + int(tail.sum())

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at >> 3]) >> (7 - (at & 7)) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        found = 0
        for plane in range(self.bits):
            bit, ones = self._bit(plane, at), self._ones(plane, at)
            found = found << 1 | bit
            at = self.zeros[plane] + ones if bit else at - ones
        return found

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the ids equal to ``token`` of a range lie below the last plane."""
        if token < 0 or token >> self.bits:
            return 0, 0
        for plane in range(self.bits):
            a, b = self._ones(plane, start), self._ones(plane, end)
            if token >> (self.bits - 1 - plane) & 1:
                start, end = int(self.zeros[plane]) + a, int(self.zeros[plane]) + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, token: int, at: int) -> int:
        """How often ``token`` stands before a position."""
        start, end = self._range(token, 0, max(0, min(at, self.size)))
        return end - start

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        low, high = self._range(token, start, self.size if end is None else end)
        return high - low

    def select(self, token: int, nth: int) -> int:
        """The position of the ``nth`` occurrence (from 0), -1 if there are fewer."""
        if not 0 <= nth < self.count(token):
            return -1
        low, high = nth, self.size
        while high - low > 1:  # the last position with at most nth occurrences before it
            middle = (low + high) // 2
            low, high = (middle, high) if self.rank(token, middle) <= nth else (low, middle)
        return low

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, n) for n in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids, from the last plane back to the first."""
        order = np.zeros(self.size, np.uint16 if self.bits <= 16 else np.uint32)
        for plane in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[plane], count=self.size).view(bool)
            before, split = np.empty_like(order), int(self.zeros[plane])
            before[np.flatnonzero(~ones)] = order[:split]
            before[np.flatnonzero(ones)] = order[split:] | order.dtype.type(1 << (self.bits - 1 - plane))
            order = before
        return order.astype(np.uint32)


SHARD = "part int, shard int, local_start long, n_ids long, doc_ids array<long>, lengths array<long>, file binary"
SHARD_ARROW = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("local_start", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("file", pa.binary()),
])


def write_shards(docs: DataFrame, path: str, vocabulary: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode all documents in ``doc_id`` order and write the shards under ``path``."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    ordered = docs.select(F.col("doc_id").cast("long"), "text")
    # Ranges are drawn from ids and hashes: no text goes to the driver for them.
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part = encoder(vocabulary, blank_matters=True), TaskContext.get().partitionId()
        number, start, held, names, lengths = 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            nonlocal number, start, held, names, lengths
            ids = np.frombuffer(b"".join(held), "<u4")
            row = {"part": part, "shard": number, "local_start": start, "n_ids": len(ids), "doc_ids": names,
                   "lengths": lengths, "file": encode(ids)}
            number, start, held, names, lengths = number + 1, start + len(ids), [], [], []
            return pa.RecordBatch.from_pylist([row], SHARD_ARROW)

        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append(ids_of(text.as_py()) + end)
                names.append(doc_id)
                lengths.append(len(held[-1]) // 4)
                size += lengths[-1]
                if size >= shard_ids:
                    size = 0
                    yield close()
        if held:
            yield close()

    ordered.mapInArrow(shards, SHARD).write.parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """The shards with ``start``: the number of all ids before the shard."""
    shards = spark.read.schema(SHARD).parquet(path)
    # One row per writing task, not per shard.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_before"))
    return shards.join(F.broadcast(offsets), "part").withColumn("start", F.col("_before") + F.col("local_start"))


def document_digests(shards: DataFrame) -> DataFrame:
    """Per document, from the decoded files: ``doc_id, start, n_tokens, ids_crc32``."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, lengths, data, start in zip(*batch.columns, strict=True):
                lengths = np.array(lengths.as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                ids = WaveletMatrix(data.as_buffer().to_pybytes()).decode().astype("<u4").tobytes()
                crcs = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends, lengths, strict=True)]
                columns = [doc_ids.as_py(), start.as_py() + ends - lengths, lengths, crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return shards.select("doc_ids", "lengths", "file", "start").mapInArrow(digests, schema)
