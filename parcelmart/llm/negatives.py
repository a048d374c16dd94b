"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of another label whose
score lies in a window under the positive's.

A component counts as the integer ``floor(scale * x)``, a score is an integer inner product, and both must be exact:
floating-point sums would turn ties and window edges. Scores come from a residue number system. The component matrices are
reduced modulo several small primes, the residues are multiplied as float32 matrices (every partial sum stays below 2**24,
so each is exact), and the signed score is put together from its residues digit by digit, by Chinese remaindering with
balanced digits. As many primes are used as the largest possible score of the two matrices needs.

Anchors are dealt into blocks of at most ``BLOCK_CELLS`` components. A block is broadcast, a size that does not grow with
the data, and meets every row where it lies: rows stream through the tasks once for the positives and once for the
negatives, and each task keeps the best few rows of each anchor only. The number of rounds grows with the anchors, so no
block, task or driver ever holds all of them.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors of
different lengths are compared as if zeros followed the shorter one. Repeated rows count each for itself; rows with the
anchor's id are not "other" rows. Ties go to the smaller id. An anchor without positives, or without rows in a window, has
no result rows. Scores beyond 64 bits raise an error. Only ``vec_id, embedding, label`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.shared import written

#: The largest primes below 512.
PRIMES = (509, 503, 499, 491, 487, 479, 467, 463)
#: So many products of balanced residues (254 at most each) add up below 2**24, exactly in float32.
SLAB = 256
#: Components of the anchors of a block, and scores that a task holds at a time.
BLOCK_CELLS, SCORE_CELLS = 1 << 20, 1 << 20
LIMIT = 1 << 63

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = "anchor int, slot int, id long, score long"


def _primes_for(bound: float) -> tuple[int, ...]:
    """The first primes whose product tells all integers from ``-bound`` to ``bound`` apart."""
    product = 1
    for count, prime in enumerate(PRIMES, 1):
        product *= prime
        if product > 2 * bound + 2:
            return PRIMES[:count]
    return PRIMES


def _residues(values: np.ndarray, prime: int) -> np.ndarray:
    """Balanced residues; ``fmod`` of whole doubles is exact."""
    rest = np.fmod(values, prime)
    return (rest - prime * np.rint(rest / prime)).astype(np.float32)


def _product(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    """``left @ right.T`` modulo ``prime``, each entry a whole float32 within one prime of zero."""
    total = np.zeros((len(left), len(right)), np.float32)
    scale = np.float32(1 / prime)
    for start in range(0, left.shape[1], SLAB):
        total += left[:, start : start + SLAB] @ right[:, start : start + SLAB].T
        total -= np.float32(prime) * np.rint(total * scale)
    return total


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices of whole doubles, as 64-bit integers."""
    if not len(left) or not len(right) or not left.shape[1]:
        return np.zeros((len(left), len(right)), np.int64)
    bound = float(np.abs(left).sum(axis=1).max()) * float(np.abs(right).max()) * (1 + 1e-9)
    if bound >= LIMIT and np.abs(left @ right.T).max() >= LIMIT * (1 - 1e-9):
        raise ValueError("a score does not fit in 64 bits; use a smaller scale")
    value, radix = np.zeros((len(left), len(right)), np.int64), 1
    for prime in _primes_for(min(bound, LIMIT)):
        rest = _product(_residues(left, prime), _residues(right, prime), prime).astype(np.int64)
        digit = (rest - value) % prime * pow(radix, -1, prime) % prime
        digit[digit > prime // 2] -= prime
        with np.errstate(over="ignore"):
            value += digit * np.int64((radix + LIMIT) % (2 * LIMIT) - LIMIT)  # sums wrap around 2**64, the score itself fits
        radix *= prime
    return value


def _integers(column: pa.Array, scale: float, width: int = 0) -> np.ndarray:
    """``floor(scale * x)`` of a list column as a matrix of doubles, zeros after shorter rows."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    result = np.zeros((len(lengths), width))
    result[np.arange(width) < lengths[:, None]] = flat
    return result


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, limit: int) -> np.ndarray:
    """Indices of the first ``limit`` entries of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    sorted_group = group[order]
    place = np.arange(len(order)) - np.searchsorted(sorted_group, sorted_group)
    return order[place < limit]


class _Search:
    """The best rows of each target: an anchor of the block, a window of scores, and the same or another label."""

    def __init__(self, block: dict, limit: int):
        self.__dict__ |= block  # ids, labels, vectors of the anchors; of, low, high of the targets; same
        self.limit = limit
        self.floor = self.low.copy()  # no row under it can still be among the best
        self.group, self.score, self.found = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        width = max(vectors.shape[1], self.vectors.shape[1])
        vectors, anchors = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (vectors, self.vectors))
        score = exact_scores(anchors, vectors)
        fits = (labels == self.labels[:, None]) & (ids != self.ids[:, None]) if self.same else labels != self.labels[:, None]
        of_target = score[self.of]
        wanted = fits[self.of] & (of_target >= self.floor[:, None]) & (of_target <= self.high[:, None])
        group, row = np.nonzero(wanted)
        if len(group):
            self._merge(group, of_target[group, row], ids[row])

    def _merge(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        group, score, ids = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.found, ids)))
        kept = _best(group, score, ids, self.limit)
        self.group, self.score, self.found = group[kept], score[kept], ids[kept]
        full = np.bincount(self.group, minlength=len(self.of)) == self.limit
        last = np.searchsorted(self.group, np.arange(len(self.of)), side="right") - 1
        self.floor[full] = self.score[last[full]]


def _found(rows: DataFrame, block: dict, limit: int, scale: float) -> DataFrame:
    """``anchor, slot, id, score, rank`` of the best rows of all targets of a block."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    step = max(1, SCORE_CELLS // max(1, len(block["of"]), len(block["ids"])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Search(shared.value, limit)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids, labels = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2))
                state.add(ids, labels, _integers(part.column(1), scale))
        target = state.group
        columns = (state.of[target].astype(np.int32), state.slot[target].astype(np.int32), state.found, state.score)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "slot", "id", "score"])

    first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return rows.mapInArrow(search, _FOUND).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= limit)


def _blocks(anchors: DataFrame, scale: float) -> DataFrame:
    """Anchors packed into rows of at most ``BLOCK_CELLS`` components, written: ``number, ids, labels, width, vectors``."""
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("width")).first()
    at_once = max(1, BLOCK_CELLS // max(1, size["width"] or 1))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                ids, labels = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2))
                vectors = _integers(part.column(1), scale)
                values = [ids.tobytes(), labels.tobytes(), vectors.shape[1], vectors.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["ids", "labels", "width", "vectors"])

    dealt = anchors.repartition(math.ceil((size["n"] or 1) / at_once))
    packed = dealt.mapInArrow(pack, "ids binary, labels binary, width long, vectors binary")
    return written(packed.select(F.monotonically_increasing_id().alias("number"), "*"), "anchors")


def hard_negatives(
    vectors: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80, scale: float = 256.0
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for anchors with ``vec_id`` divisible by
    ``anchor_every``. A negative's score is at least ``percent`` hundredths of the positive's and not above it.
    """
    spark = vectors.sparkSession
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select("vec_id", "embedding", "label").dropna().where(~broken)
    blocks = _blocks(rows.where(F.col("vec_id") % anchor_every == 0), scale)
    results = []
    for (number,) in blocks.select("number").collect():  # a number for each BLOCK_CELLS components
        ids, labels, width, matrix = blocks.where(F.col("number") == number).drop("number").first()
        ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        block = {"ids": ids, "labels": labels, "vectors": np.frombuffer(matrix).reshape(len(ids), width)}
        every, widest = np.arange(len(ids)), np.iinfo(np.int64)
        whole = {"of": every, "slot": 0 * every, "low": np.full(len(ids), widest.min), "high": np.full(len(ids), widest.max), "same": True}
        near = _found(rows, block | whole, positives, scale).orderBy("anchor", "rank").toPandas()  # a few rows for each anchor of the block
        near = near[near["score"] >= 0]  # under a negative score the window is empty
        score, of = near["score"].to_numpy(np.int64), near["anchor"].to_numpy(np.int64)
        low = score // 100 * percent - (-(score % 100) * percent) // 100
        targets = {"of": of, "slot": near["rank"].to_numpy(np.int64), "low": low, "high": score, "same": False}
        chosen = near.assign(anchor_id=ids[of])[["anchor", "rank", "anchor_id", "id", "score"]]
        named = spark.createDataFrame(chosen.astype("int64"), "anchor long, slot long, anchor_id long, positive_id long, positive_score long")
        found = _found(rows, block | targets, negatives, scale)
        joined = found.join(F.broadcast(named), ["anchor", "slot"])  # at most ``positives`` rows for each anchor of the block
        names = ["anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
        results.append(written(joined.select(*names), "negatives"))
    if not results:
        return spark.createDataFrame([], RESULT)
    union = results[0]
    for part in results[1:]:
        union = union.unionByName(part)
    return union
