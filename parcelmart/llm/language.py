"""Language identification of texts that may mix languages.

A language is a distribution over hashed letter trigrams, learnt from labelled documents. A document is a mixture: the
expectation-maximisation algorithm estimates the proportions under which its trigrams are most likely. Which languages
take part is chosen by penalised likelihood: languages are added in order of their share in the full mixture as long as
the log-likelihood gains more than ``log(trigrams) / 2`` (the Bayesian criterion) for each. The answer is the language
with the largest proportion, its score that proportion.

Learning counts trigrams of ``sample_rows`` documents of each language, drawn by a hash of ``doc_id``: counts of a
fixed number of buckets, summed by Spark, so that what is sent to the tasks has a fixed size. Prediction is a Pandas
UDF over whole texts.

Defined results: texts that are null, empty or without letters are ``und`` with score 0; without labelled documents
every text is; ties go to the language that sorts first; repeated rows get equal results; rows with a null id are
predicted and never learnt from. Only ``doc_id``, ``text`` and ``lang`` are read, other columns pass through.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
SAMPLE_ROWS = 3000
ROUNDS, CLOSE = 30, 1e-3
UNKNOWN = "und"
#: Pseudo-counts spread over all buckets of a language.
SMOOTH = 0.5

_LETTERS = np.array([chr(c).isalpha() for c in range(0x3000)])


def _letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for what is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    known = codes < len(_LETTERS)
    letters = np.zeros(len(codes), bool)
    letters[known] = _LETTERS[codes[known]]
    if not known.all():
        letters[~known] = [chr(c).isalpha() for c in codes[~known].tolist()]
    return np.where(letters, codes, 0)


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams around each letter and how often they occur; word edges count as a character."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.concatenate(([0], _letter_codes(text), [0])).astype(np.uint64)
    middle = codes[1:-1]
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) ^ middle * np.uint64(0x85EBCA77) ^ codes[2:] * np.uint64(0xC2B2AE3D)) * np.uint64(
        0x9E3779B97F4A7C15
    )
    buckets = (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS
    counts = np.bincount(buckets[middle > 0], minlength=BUCKETS)
    present = np.flatnonzero(counts)
    return present, counts[present]


def _proportions(rows: np.ndarray, counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture proportions by expectation-maximisation, and the log-likelihood. ``rows``: probability per language."""
    share, total = start, counts.sum()
    for _ in range(ROUNDS):
        new = share * ((counts / (rows @ share)) @ rows) / total
        done = np.abs(new - share).max() < CLOSE
        share = new
        if done:
            break
    return share, float(counts @ np.log(rows @ share))


def mixture(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Proportions of all languages, 0 for those the penalised likelihood leaves out."""
    languages = rows.shape[1]
    share, _ = _proportions(rows, counts, np.full(languages, 1 / languages))
    order = np.argsort(-share, kind="stable")
    penalty = 0.5 * np.log(counts.sum())
    chosen, best = np.array([1.0]), float(counts @ np.log(rows[:, order[0]]))
    for size in range(2, languages + 1):
        part, value = _proportions(rows[:, order[:size]], counts, np.full(size, 1 / size))
        if value - penalty <= best:
            break
        chosen, best = part, value
    result = np.zeros(languages)
    result[order[: len(chosen)]] = chosen
    return result


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order and the probability of each bucket (row) in each (column)."""
    known = docs.select("doc_id", "text", "lang").dropna().where(~held_out(F.col("doc_id")))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # one row per language
    share = F.lit(float(sample_rows)) / F.col("n")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = known.join(F.broadcast(sizes), "lang").where(draw < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*batch.columns, strict=True):
                own = sums.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
                buckets, counts = trigram_counts(text.as_py())
                own[buckets] += counts
        for lang, own in sums.items():
            present = np.flatnonzero(own)
            columns = [pa.array([lang] * len(present), pa.string()), pa.array(present, pa.int32()), pa.array(own[present], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    counted = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas().astype({"bucket": "int64", "n": "int64"})  # at most BUCKETS rows for each language
    languages = sorted(table["lang"].unique())
    rows = np.full((BUCKETS, len(languages)), SMOOTH)
    rows[table["bucket"], [languages.index(x) for x in table["lang"]]] += table["n"]
    return languages, rows / rows.sum(axis=0) if languages else rows


def with_languages(docs: DataFrame, model: tuple[list[str], np.ndarray], name: str = "_lang") -> DataFrame:
    """Add a struct ``name``: ``lang``, ``score`` and ``shares`` (each language's proportion)."""
    languages, rows = model
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf("lang string, score double, shares map<string,double>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for texts in batches:
            found = []
            for text in texts:
                buckets, counts = trigram_counts(text)
                if not len(buckets) or not languages:
                    found.append((UNKNOWN, 0.0, {}))
                    continue
                share = mixture(table[buckets], counts)
                best = int(share.argmax())
                named = {sys.intern(x): float(p) for x, p in zip(languages, share, strict=True) if p > 0}
                found.append((languages[best], min(1.0, float(share[best])), named))
            yield pd.DataFrame(found, columns=["lang", "score", "shares"])

    return docs.withColumn(name, judge("text"))


def language_id(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row ``doc_id, held_out, lang_pred, score, shares``; learnt from rows of ``docs`` that are not held out."""
    judged = with_languages(docs.select("doc_id", "text"), learn(docs, sample_rows))
    return judged.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang.lang").alias("lang_pred"),
        F.col("_lang.score").alias("score"), F.col("_lang.shares").alias("shares"),
    )
