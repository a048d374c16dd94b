"""Substring removal by repeated-phrase automata.

A passage recurs if a window of ``length`` consecutive words starts at two places anywhere. Four steps find them all:

1. Anchors. Each window names the smallest hash of its inner phrases of eight words; equal windows name the same one.
   One word in fourteen is an anchor, so counting anchors shuffles a fraction of the words. Anchors met once end here.
2. Segments. The words around an anchor met twice or more, just enough to hold the windows that name it. Equal texts
   are one text from here on, with a mark that all its windows recur.
3. Confirmation. Segments are dealt to shards by anchor, so a shard holds all places of its windows and counts them
   itself, first by hash, then word by word. Only for anchors split over tasks windows are counted by a shuffle before,
   and that 64-bit count alone decides.
4. Location. Each shard compiles the recurring windows it holds into one Aho-Corasick automaton over word codes and
   streams all its segments through it; the automaton sees words, not hashes.

An anchor that a third of all documents share is spread over many tasks by document; each gets the confirmed windows
that it holds. Groups hold about ``shard_rows`` segments, so memory does not grow with the table.

Defined results: null and empty texts have no words; documents shorter than a window lose nothing; repeated rows are
each other's copies and lose all words of their windows; null ids count like others; an empty table gives no rows.
Only ``doc_id`` and ``text`` are read, other columns pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import tidy
from parcelmart.shared import written

LENGTH = 35
INNER = 8
SHARD_ROWS = 2000
SPREAD_BITS = 20
PLACE = np.uint64(0xFFFFFFFF)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def run_hashes(run: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, from their hashes, by doubling: of two runs, of four, and so on."""
    count = len(run) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out, done, width = np.full(count, np.uint64(size)), 0, 1
    while True:
        if size & width:
            out = (out ^ run[done : done + count]) * MIX[0]
            out ^= out >> np.uint64(29)
            done += width
        if done == size:
            return out
        run = (run[:-width] * MIX[1] + run[width:]) * MIX[0]
        run ^= run >> np.uint64(32)
        width *= 2


def _anchors(words: np.ndarray, length: int, inner: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window its smallest inner hash, and at which of the words that lies (the first of equals)."""
    hashes = run_hashes(words, inner)
    span = length - inner + 1
    if len(hashes) < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # The place stands in for the lower half of a hash, so that one minimum, taken by doubling, brings both.
    least, width = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[: len(hashes) - span + 1], least[span - width :])
    places = (least & PLACE).astype(np.int64)
    return hashes[places], places


def text_key(text: str = "text"):
    """Equal for equal texts, 128 bits; null and empty texts are alike here."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def anchors(docs: DataFrame, length: int, inner: int) -> DataFrame:
    """One row per document and anchor: ``key`` (of the text), ``anchor`` (hash) and the number of its places."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found, places = [], [], []
            for key, text in zip(*batch.columns, strict=True):
                named, at = _anchors(word_hashes((text.as_py() or b"").split()), length, inner)
                if len(named):
                    first = np.concatenate(([True], at[1:] != at[:-1]))
                    own, n = np.unique(named[first], return_counts=True)
                    keys.append(pa.repeat(key, len(own)))
                    found.append(own.view(np.int64))
                    places.append(n.astype(np.int32))
            if keys:
                columns = [pa.concat_arrays(keys), pa.array(np.concatenate(found)), pa.array(np.concatenate(places))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "anchor", "places"])

    source = docs.select(text_key().alias("key"), F.col("text").cast("binary").alias("t"))
    return source.mapInArrow(tidy(find), "key binary, anchor long, places int")


SEGMENT = "key binary, first int, dest long, alike boolean, words binary, hashes binary"


def _segments(texts: DataFrame, length: int, inner: int, shards: int, shard_rows: int) -> DataFrame:
    """Words around recurring anchors: for each stretch of windows that name one anchor, the words and window hashes.

    ``first``: number of the first word. ``dest``: the anchor's shard and over how many tasks the shard is spread for
    it. ``alike``: other documents have the same text.
    """
    names = [x.split()[0] for x in SEGMENT.split(", ")]
    kinds = [pa.binary(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = [[] for _ in names]
                for key, text, copies, marks in zip(*batch.slice(at, 500).columns, strict=True):
                    key, alike, words = key.as_py(), copies.as_py() > 1, text.as_py().split()
                    wanted = {m["anchor"]: m["met"] for m in marks.as_py()}
                    numbers = word_hashes(words)
                    named, _ = _anchors(numbers, length, inner)
                    hashes = run_hashes(numbers, length)
                    edges = np.flatnonzero(np.concatenate(([True], named[1:] != named[:-1], [True])))
                    for low, high, anchor in zip(edges[:-1], edges[1:], named[edges[:-1]].view(np.int64).tolist()):
                        if met := wanted.get(anchor):
                            dest = anchor % shards << SPREAD_BITS | min(-(-met // shard_rows), (1 << SPREAD_BITS) - 1)
                            part = b" ".join(words[low : high + length - 1])
                            row = (key, low, dest, alike, part, hashes[low:high].tobytes())
                            for column, value in zip(rows, row, strict=True):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    return texts.select("key", "t", "copies", "marks").mapInArrow(tidy(cut), SEGMENT)


def _windows(segments: DataFrame) -> DataFrame:
    """One row per window of a segment, two if other documents have the text: its hash and the task that holds it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [h.as_py() for h in batch.column(3)]
            times = np.where(batch.column(2).to_numpy(zero_copy_only=False), 2, 1)
            sizes = np.array([len(h) // 8 for h in found], dtype=np.int64)
            each_ = np.repeat(times, sizes)
            columns = [np.frombuffer(b"".join(found), np.int64), *(np.repeat(batch.column(k).to_numpy(), sizes) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(c, each_)) for c in columns], ["hash", "_shard", "_salt"])

    return segments.select("_shard", "_salt", "alike", "hashes").mapInArrow(tidy(each), "hash long, _shard long, _salt long")


class _Codes(dict):
    """One character for each different word of a shard, past the surrogates."""

    def __missing__(self, word: bytes) -> str:
        n = len(self)
        self[word] = found = chr(n + 0x100 if n < 0xD600 else n + 0x900)
        return found


def _locate(length: int):
    def run(key: tuple, segments: pd.DataFrame, recurring: pd.DataFrame) -> pd.DataFrame:
        """One shard: compile the recurring windows, stream the segments, give the runs of windows found."""
        codes, places, texts = _Codes(), Counter(), []
        alone = (segments["dest"].to_numpy(np.int64) & ((1 << SPREAD_BITS) - 1)) <= 1
        weights = np.where(alone & ~segments["alike"].to_numpy(bool), 1, 2)
        sizes = segments["hashes"].str.len().to_numpy(np.int64) // 8
        hashes = np.frombuffer(b"".join(segments["hashes"]), np.int64)
        # All places of a window lie in this task, unless its anchor is spread: those were counted before.
        values, codes_of = np.unique(hashes, return_inverse=True)
        times = np.bincount(codes_of, np.repeat(np.where(alone, weights, 0), sizes), len(values))
        hits = ((times > 1) | np.isin(values, recurring["hash"].to_numpy(np.int64)))[codes_of]
        ends = np.cumsum(sizes)
        for raw, weight, low, high in zip(segments["words"], weights.tolist(), ends - sizes, ends, strict=True):
            text = "".join(map(codes.__getitem__, raw.split()))
            texts.append(text)
            for i in np.flatnonzero(hits[low:high]).tolist():
                places[text[i : i + length]] += weight
        patterns = [pattern for pattern, n in places.items() if n > 1]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for pattern in patterns:
            automaton.add_word(pattern)
        automaton.make_automaton()
        rows = []
        for own, first, text in zip(segments["key"], segments["first"], texts, strict=True):
            start = last = None
            for end, _ in automaton.iter(text) if patterns else ():
                if last is not None and end != last + 1:
                    rows.append((own, first + start, first + last + 1))
                    start = None
                start, last = end - length + 1 if start is None else start, end
            if last is not None:
                rows.append((own, first + start, first + last + 1))
        found = pd.DataFrame(rows, columns=["key", "start", "stop"])
        return found.astype({"start": "int32", "stop": "int32"})

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, inner: int = INNER, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per text (``key``): ``spans``, word ranges covered by recurring windows."""
    all_anchors = written(anchors(docs, length, inner), "anchors")
    counts = all_anchors.groupBy("anchor").agg(F.sum("places").alias("met")).where("met > 1")
    recurring_anchors = written(all_anchors.join(counts, "anchor").select("key", "anchor", "met"), "recurring")
    marks = recurring_anchors.groupBy("key").agg(
        F.collect_set(F.struct("anchor", "met")).alias("marks")  # bounded by one document's words
    )
    # Copies are combined before the shuffle: a text that a third of all documents share moves once per task.
    texts = docs.select(text_key().alias("key"), F.col("text").cast("binary").alias("t")).groupBy("key").agg(
        F.first("t").alias("t"), F.count(F.lit(1)).alias("copies")
    )
    shards = max(1, recurring_anchors.count() // shard_rows)
    segments = written(_segments(texts.join(marks, "key"), length, inner, shards, shard_rows), "segments")
    tasks = F.col("dest").bitwiseAND(F.lit((1 << SPREAD_BITS) - 1))
    own = F.pmod(F.xxhash64("key", "first"), F.greatest(tasks, F.lit(1)))
    dealt = segments.withColumn("_shard", F.shiftright("dest", SPREAD_BITS)).withColumn("_salt", own)
    # Only windows of anchors that are spread over tasks need a count beyond their task, and go to those that hold them.
    held = _windows(dealt.where(tasks > 1)).groupBy("hash", "_shard", "_salt").agg(F.count(F.lit(1)).alias("n"))
    met = held.groupBy("hash", "_shard").agg(F.sum("n").alias("n"), F.collect_list("_salt").alias("_salts")).where("n > 1")
    copies = met.select("_shard", F.explode("_salts").alias("_salt"), "hash")
    runs = (
        dealt.groupBy("_shard", "_salt")
        .cogroup(copies.groupBy("_shard", "_salt"))
        .applyInPandas(_locate(length), "key binary, start int, stop int")
    )
    return runs.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows and columns of ``docs`` with ``kept`` (binary: kept words, one blank between), ``n_words``, ``n_removed``."""
    spans = repeated_spans(docs, length)
    keyed = docs.withColumn("_key", text_key())
    met = keyed.join(spans, keyed["_key"] == spans["key"], "left").select(*[keyed[c] for c in docs.columns], spans["spans"].alias("_spans"))

    @F.pandas_udf("kept binary, n_words long, n_removed long")
    def keep(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, own in zip(texts, spans, strict=True):
            words = (text or b"").split()
            n, gone = len(words), 0
            if own is not None and len(own):
                left = np.ones(n, bool)
                for span in own:
                    left[span["start"] : span["stop"]] = False
                words = [words[i] for i in np.flatnonzero(left)]
                gone = n - len(words)
            rows.append((b" ".join(words), n, gone))
        return pd.DataFrame(rows, columns=["kept", "n_words", "n_removed"])

    return met.withColumn("_kept", keep(F.col("text").cast("binary"), "_spans")).drop("_spans")


def substring_removal(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row ``doc_id, n_words, n_removed, kept_sha256``."""
    met = without_repeats(docs.select("doc_id", "text"), length)
    return met.select(
        "doc_id", "_kept.n_words", "_kept.n_removed", F.sha2(F.col("_kept.kept"), 256).alias("kept_sha256")
    )


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with recurring passages cut from ``text``; a document that had words and keeps none goes.

    Untouched texts stay as they are; ``n_chars``, if there, follows the new text.
    """
    met = without_repeats(docs, length).where("_kept.n_removed = 0 OR _kept.n_removed < _kept.n_words")
    text = F.when(F.col("_kept.n_removed") > 0, F.col("_kept.kept").cast("string")).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        count = F.char_length(F.col("_kept.kept").cast("string")).cast("long")
        changed["n_chars"] = F.when(F.col("_kept.n_removed") > 0, count).otherwise(F.col("n_chars"))
    return met.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])
