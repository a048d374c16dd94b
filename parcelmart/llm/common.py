"""What the operators share: reading a given table, and the test for missing columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.shared import settings  # noqa: F401  (for the operators)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


#: Of what tasks hand to their Python workers at a time.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches are bounded in bytes too, so that long texts make no large ones. The queries call it first."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the machine. A worker lives on after its task, and the next one may need it elsewhere."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


#: What a worker process keeps from one task to the next, by kind.
KEPT: dict[str, dict] = {}


def let_go(but: str | None = None) -> None:
    """Forget what tasks of other kinds kept in this worker: a later stage of the session needs the memory."""
    held = [store for kind, store in KEPT.items() if kind != but and store]
    for store in held:
        store.clear()
    if held:
        give_back()


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str | None = None):
    """``work`` over a task's batches, which leaves no freed memory behind; of what earlier tasks kept only ``keeps`` stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keeps)
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character, accented ones included, stays."""
    return F.translate(text, UPPER, LOWER)


def row_key(*columns: str) -> Column:
    """A hash of a row's content. Rows that agree in these columns get equal results, so they may share a key."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in columns])
