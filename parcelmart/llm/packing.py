"""Best-fit packing by exact-complement hashing.

Which pieces go together depends on their lengths alone, and there are at most ``limit`` different lengths. So the
plan is made on the histogram of lengths, whatever the number of pieces: for the longest length left, combinations of
one, two or three shorter lengths that fill its gap exactly are looked up in hash tables of single, pair and triple
sums and used as often as all of them are available; what is left goes best-fit into the smallest gap that takes it.
The plan says which ranks of each length go where. Pieces get their rank from a range-partitioned order by length, so
a length that a third of all pieces share is spread over many tasks.

Defined results: a null or empty text is the end id alone; repeated rows are packed once each; an empty table gives
no pieces. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import let_go, tidy
from parcelmart.llm.tokens import WORDS, encoder
from parcelmart.operators.ordering import with_row_number
from parcelmart.shared import written

END_ID = 0
LIMIT = 2048


def tokenized_pieces(docs: DataFrame, vocabulary: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Per piece ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (32 bits each)."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, blank_matters=False)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                for number, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    row = (doc_id, number, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for column, value in zip(rows, row, strict=False):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=False)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(pieces, WORDS), schema)


def _pair_sums(counts: Counter, limit: int) -> dict[int, list[tuple[int, int]]]:
    """Each sum below ``limit`` of two available lengths, with the pairs that give it, longest length first."""
    lengths = sorted(counts, reverse=True)
    pairs = defaultdict(list)
    for i, a in enumerate(lengths):
        for b in lengths[i:]:
            if a + b < limit:
                pairs[a + b].append((a, b))
    return pairs


def _times(counts: Counter, pattern: tuple[int, ...]) -> int:
    return min(counts[x] // n for x, n in Counter(pattern).items())


def plan_sequences(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) and how often each is used; every piece is in exactly one."""
    counts, plan = Counter({k: n for k, n in histogram.items() if n}), []
    if counts[limit]:
        plan.append(((limit,), counts.pop(limit)))
    pairs = _pair_sums(counts, limit)

    def use(pattern: tuple[int, ...]) -> None:
        if times := _times(counts, pattern):
            plan.append((pattern, times))
            for x in pattern:
                counts[x] -= times

    for a in sorted(counts, reverse=True):
        gap = limit - a
        if counts[a]:
            use((a, gap))
        for pair in pairs.get(gap, ()):
            if not counts[a]:
                break
            use((a, *pair))
        for b in sorted((x for x in counts if counts[x] and x < gap), reverse=True) if counts[a] else ():
            for pair in pairs.get(gap - b, ()):  # a triple is a length and a pair no longer than it
                if pair[0] <= b and counts[a] and counts[b]:
                    use((a, b, *pair))
            if not counts[a]:
                break
    # Best fit for the rest, longest first: into the smallest gap that takes the piece; equal sequences go as one.
    gaps: dict[int, list[list]] = defaultdict(list)
    for a in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[a]
        while left:
            gap = min((g for g, groups in gaps.items() if g >= a and groups), default=None)
            if gap is None:
                each = limit // a
                full, over = divmod(left, each)
                if full:
                    gaps[limit - a * each].append([(a,) * each, full])
                if over:
                    gaps[limit - a * over].append([(a,) * over, 1])
                break
            pattern, times = gaps[gap].pop()
            used = min(times, left)
            if used < times:
                gaps[gap].append([pattern, times - used])
            gaps[gap - a].append([(*pattern, a), used])
            left -= used
    return plan + [(pattern, times) for groups in gaps.values() for pattern, times in groups]


def _places(histogram: dict[int, int], limit: int) -> tuple[np.ndarray, ...]:
    """Ranges of row numbers (pieces by length) with the sequence and offset of their first row."""
    before, total = {}, 0
    for length in sorted(histogram):
        before[length], total = total, total + histogram[length]
    used, sequence, rows = Counter(), 0, []
    for pattern, times in plan_sequences(histogram, limit):
        offset = 0
        for length in pattern:
            rows.append((before[length] + used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    rows.sort()
    return tuple(np.array(column, dtype=np.int64) for column in zip(*rows, strict=True)) if rows else ()


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id, piece, length, ids_crc32`` and any other columns."""
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``limit`` rows
    places = spark.sparkContext.broadcast(_places({r["length"]: r["n"] for r in counted}, limit))
    order = [F.col("length"), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    numbered = with_row_number(pieces, *order, name="_rank", total="_total").drop("_total")

    @F.pandas_udf("sequence_id long, offset long")
    def place(rank: pd.Series) -> pd.DataFrame:
        let_go()  # the pieces are written: the words that served them are not needed any more
        first, sequence, offset = places.value
        number = rank.to_numpy() - 1
        at = np.searchsorted(first, number, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + number - first[at], "offset": offset[at]})

    return numbered.withColumn("_place", place("_rank")).select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, vocabulary: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Tokenize once (the pieces are written, so that the plan and the placing see the same rows), then pack."""
    return pack(written(tokenized_pieces(docs, vocabulary, limit, with_ids), "pieces"), limit)
