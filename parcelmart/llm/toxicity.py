"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals.

Labels belong to documents, so words get theirs first: in a bounded, near-copy-free sample of labelled documents, words
and word beginnings that keep to toxic documents (by likelihood ratio) mark the words of toxic documents that are
offensive. The field learns to tag these from word, prefix and suffix weights and the tag of the neighbouring words;
it is fitted on one half of the sample. On the other half a logistic curve maps a document's marginals (expected number
of toxic words, their density, the largest one) to the probability of the label.

Fitting is one task over ``sample_rows`` documents of either label; scoring is a Pandas UDF over all rows, whole texts.

Defined results: null and empty texts have no words and get the curve's value at zero; without labels every score is
0; repeated rows get equal scores; labels that disagree for one id count as toxic; documents with a null id are scored
and never used for fitting. Of ``docs`` only ``doc_id`` and ``text`` are read, other columns pass through.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import give_back, let_go

BUCKETS = 1 << 18
SAMPLE_ROWS = 2000
#: Fitting cuts sequences here; scoring never does.
FIT_WORDS = 500
THRESHOLD = 0.3
#: Characters of the texts scored together.
BLOCK_CHARS = 2_000_000
EDGES = ".,;:!?|\"'()[]{}*#$%&-_"
#: Likelihood ratio and share of toxic documents from which a word or beginning marks toxic words.
MARK_RATIO, MARK_SHARE, MARK_DOCUMENTS = 20.0, 0.95, 3
STORED_WORDS = 150_000


def word_features(raw: str) -> list[int]:
    """Buckets of a word, its beginnings and its end."""
    w = raw.strip(EDGES).lower()
    return [zlib.crc32(f.encode()) % BUCKETS for f in ("w" + w, "3" + w[:3], "4" + w[:4], "5" + w[:5], "s" + w[-3:])]


def chain_marginals(scores: np.ndarray, lengths: np.ndarray, chain: np.ndarray, cells: int = 600_000, pairs=None):
    """P(tag 1) of every word of many sequences laid end to end; ``chain``: start score and 2 x 2 transition scores.

    Both recursions run on the ratio of the two tags, for all sequences of a block at once, longest first. ``pairs``
    collects the expected number of each transition.
    """
    start, (t00, t01, t10, t11) = np.exp(chain[0]), np.exp(chain[1:])
    ends, out = np.cumsum(lengths), np.zeros(len(scores))
    odds = np.exp(np.clip(scores, -30, 30))
    order = [i for i in np.argsort(-lengths, kind="stable") if lengths[i]]
    while order:
        steps = int(lengths[order[0]])
        block, order = order[: max(1, cells // steps)], order[max(1, cells // steps) :]
        own = lengths[block]
        emit, ahead, back = (np.ones((steps, len(block))) for _ in range(3))
        for column, i in enumerate(block):
            emit[: lengths[i], column] = odds[ends[i] - lengths[i] : ends[i]]
        active = np.searchsorted(-own, -np.arange(steps), side="left")  # sequences longer than t
        ahead[0] = emit[0] * start
        for t in range(1, steps):
            n, before = active[t], ahead[t - 1, : active[t]]
            ahead[t, :n] = np.clip(emit[t, :n] * (t01 + t11 * before) / (t00 + t10 * before), 1e-15, 1e15)
        for t in range(steps - 2, -1, -1):
            n = active[t + 1]
            x = emit[t + 1, :n] * back[t + 1, :n]
            back[t, :n] = (t10 + t11 * x) / (t00 + t01 * x)
        joint = ahead * back
        joint /= 1 + joint
        for column, i in enumerate(block):
            out[ends[i] - lengths[i] : ends[i]] = joint[: lengths[i], column]
        if pairs is not None and steps > 1:
            x, r, real = emit[1:] * back[1:], ahead[:-1], np.arange(1, steps)[:, None] < own
            whole = t00 + t01 * x + r * (t10 + t11 * x)
            pairs += [(part / whole)[real].sum() for part in (np.full_like(x, t00), t01 * x, t10 * r, t11 * r * x)]
    return out


def _distinct(texts: list[str]) -> list[int]:
    """Rows left when near copies go: those whose smallest hash of five words was seen before, under one of two orders."""
    seen, kept = set(), []
    for row, text in enumerate(texts):
        words = text.split()
        grams = [zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))]
        marks = {(0, min(grams)), (1, max(grams))}
        if not marks & seen:
            kept.append(row)
        seen |= marks
    return kept


def _mark_words(docs: list[list[str]], toxic: np.ndarray, features: dict[str, list[int]]) -> list[np.ndarray]:
    """1 for the words of toxic documents that hold a feature found almost only there."""
    in_toxic, in_other = Counter(), Counter()
    for words, label in zip(docs, toxic, strict=True):
        (in_toxic if label else in_other).update({f for w in set(words) for f in features[w]})
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    marks = set()
    for f, a in in_toxic.items():
        b = in_other[f]
        share = (a / n1) / (a / n1 + b / n0)
        rate = (a + b) / (n1 + n0)
        ratio = 2 * (a * np.log(a / n1 / rate) + (b * np.log(b / n0 / rate) if b else 0))
        if a >= MARK_DOCUMENTS and share >= MARK_SHARE and ratio >= MARK_RATIO:
            marks.add(f)
    marked = {w for w, fs in features.items() if marks.intersection(fs)}
    return [np.array([label and w in marked for w in words], dtype=float) for words, label in zip(docs, toxic, strict=True)]


def _fit_field(docs: list[list[str]], tags: list[np.ndarray], features: dict[str, list[int]], rounds: int = 25):
    """Weights by Adam on the log-likelihood, all sequences at once; words that repeat share one row."""
    kinds = {w: i for i, w in enumerate(dict.fromkeys(w for words in docs for w in words))}
    table = np.array([features[w] for w in kinds], dtype=np.int64).reshape(len(kinds), 5)
    words = np.fromiter((kinds[w] for d in docs for w in d), dtype=np.int64)
    lengths, truth = np.array([len(d) for d in docs], dtype=np.int64), np.concatenate(tags) if tags else np.zeros(0)
    inside = np.ones(len(words), bool)
    inside[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    at = np.flatnonzero(inside)
    steps = np.bincount((2 * truth[at - 1] + truth[at]).astype(int), minlength=4) if len(at) else np.zeros(4)
    weights, bias, chain = np.zeros(BUCKETS), 0.0, np.zeros(5)
    first, second = (np.zeros(BUCKETS + 6) for _ in range(2))
    for turn in range(1, rounds + 1):
        pairs = np.zeros(4)
        p = chain_marginals((weights[table].sum(axis=1) + bias)[words], lengths, chain, pairs=pairs)
        off = np.bincount(words, truth - p, minlength=len(kinds))
        grad = np.bincount(table.ravel(), np.repeat(off, table.shape[1]), minlength=BUCKETS) - 0.3 * weights
        slope = np.concatenate((grad, [(truth - p).sum(), (truth - p)[~inside].sum()], steps - pairs - 0.3 * chain[1:]))
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.3 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-6)
        weights, bias, chain = weights + move[:BUCKETS], bias + move[BUCKETS], chain + move[BUCKETS + 1 :]
    return weights.astype(np.float32), float(bias), chain


def summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: log of the expected toxic words, their density, the largest marginal, and 1."""
    ends = np.cumsum(lengths)
    total = np.concatenate(([0.0], np.cumsum(p)))
    expected = total[ends] - total[ends - lengths]
    largest = np.zeros(len(lengths))
    if len(p):
        largest[lengths > 0] = np.maximum.reduceat(p, (ends - lengths)[lengths > 0])
    return np.stack([np.log1p(expected), expected / np.sqrt(np.maximum(lengths, 1)), largest, np.ones(len(lengths))], 1)


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a light penalty."""
    curve = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 0.1 * curve
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(curve))
        curve = curve + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return curve


def fit(texts: list[str], toxic: list[int], weight: list[float]) -> dict:
    """The model of a sample: field weights, chain and curve. ``weight``: how many rows each sampled row stands for."""
    rows = _distinct(texts)
    docs = [texts[i].split() for i in rows]
    labels, weights = np.array([toxic[i] for i in rows], dtype=int), np.array([weight[i] for i in rows], dtype=float)
    features = {w: word_features(w) for w in {w for d in docs for w in d}}
    tags = _mark_words(docs, labels, features)
    half = np.array([zlib.crc32(texts[i].encode()) % 2 for i in rows], dtype=int)
    learn, held = np.flatnonzero(half == 1), np.flatnonzero(half == 0)
    if not len(learn) or not len(held):  # a sample of one text or so: both halves are the whole
        learn = held = np.arange(len(docs))
    cuts = [(i, at) for i in learn for at in range(0, len(docs[i]), FIT_WORDS)]
    parts = [[source[i][at : at + FIT_WORDS] for i, at in cuts] for source in (docs, tags)]
    field, bias, chain = _fit_field(*parts, features)
    score = {w: float(field[f].sum() + bias) for w, f in features.items()}
    lengths = np.array([len(docs[i]) for i in held], dtype=np.int64)
    flat = np.array([score[w] for i in held for w in docs[i]])
    x = summary(chain_marginals(flat, lengths, chain), lengths)
    curve = _fit_curve(x, labels[held], weights[held] / weights.mean()) if len(held) else np.zeros(4)
    return {"field": field, "bias": bias, "chain": chain, "curve": curve}


class _Parts(dict):
    """Weight of a beginning or end of a word; cleared when it holds too many."""

    def __init__(self, field: list[float]):
        super().__init__()
        self.field = field

    def __missing__(self, part: str) -> float:
        if len(self) >= STORED_WORDS:
            self.clear()
        self[part] = found = self.field[zlib.crc32(part.encode()) % BUCKETS]
        return found


class _Scores(dict):
    """Emission score of a word, the sum over ``word_features``; cleared when it holds too many."""

    def __init__(self, model: dict):
        super().__init__()
        self.field, self.bias = model["field"].tolist(), model["bias"]
        self.parts = _Parts(self.field)

    def __missing__(self, word: str) -> float:
        if len(self) >= STORED_WORDS:
            self.clear()
        w, parts = word.strip(EDGES).lower(), self.parts
        whole = self.field[zlib.crc32(b"w" + w.encode()) % BUCKETS]
        self[word] = found = (
            whole + parts["3" + w[:3]] + parts["4" + w[:4]] + parts["5" + w[:5]] + parts["s" + w[-3:]] + self.bias
        )
        return found


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be used."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def fit_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> bytes | None:
    """Fit on ``sample_rows`` documents of either label, drawn by a hash of ``doc_id``; None without labels.

    A drawn id gives one row, the text with the least hash, however many rows bear it.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(learnable(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    sizes = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("_toxic") == label, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    # About sample_rows ids of each label, whatever the size of the tables: small enough for every executor.
    chosen = F.broadcast(known.withColumn("_share", share).where(draw < F.col("_share")))
    sample = docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    sample = sample.groupBy("doc_id", "_toxic", "_share").agg(one).select("doc_id", "one.text", "_toxic", "_share")

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        rows = pd.concat([f for f in frames] or [pd.DataFrame({"text": [], "doc_id": [], "_toxic": [], "_share": []})])
        rows = rows.sort_values(["doc_id", "text"])
        if rows.empty:
            return
        model = fit(rows["text"].tolist(), rows["_toxic"].astype(int).tolist(), (1 / rows["_share"]).tolist())
        yield pd.DataFrame({"model": [pickle.dumps(model)]})
        del model, rows
        give_back()

    fitted = sample.repartition(1).mapInPandas(learn, "model binary").collect()
    return bytes(fitted[0]["model"]) if fitted else None


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    """Whole texts, about ``BLOCK_CHARS`` characters at a time."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _spans(text: str, words: list[str], p: np.ndarray) -> list[dict]:
    found, place = [], 0
    if len(words) and p.max() >= 0.5:
        for word, q in zip(words, p, strict=True):
            place = text.index(word, place)
            if q >= 0.5:
                found.append({"start": place, "end": place + len(word), "p": float(q)})
            place += len(word)
    return found


def with_toxicity(docs: DataFrame, model: bytes | None, name: str = "_tox", spans: bool = True) -> DataFrame:
    """Add a struct ``name``: ``score`` and, if asked for, ``spans`` (start and end character, probability) of toxic words."""
    if model is None:
        nothing = F.array().cast("array<struct<start:int,end:int,p:double>>")
        return docs.withColumn(name, F.struct(F.lit(0.0).alias("score"), *[nothing.alias("spans")] * spans))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double" + ", spans array<struct<start:int,end:int,p:double>>" * spans)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        let_go()
        held = pickle.loads(shared.value)
        scores = _Scores(held)
        for texts in batches:
            result, found = [np.zeros(0)], []
            for block in _blocks([t or "" for t in texts]):
                words = [t.split() for t in block]
                lengths = np.array([len(w) for w in words], dtype=np.int64)
                flat = np.fromiter((scores[w] for d in words for w in d), dtype=np.float64, count=int(lengths.sum()))
                p = chain_marginals(flat, lengths, held["chain"])
                result.append(1 / (1 + np.exp(-np.clip(summary(p, lengths) @ held["curve"], -30, 30))))
                if spans:
                    ends = np.cumsum(lengths)
                    found += [_spans(t, w, p[end - len(w) : end]) for t, w, end in zip(block, words, ends, strict=True)]
            columns = {"score": np.concatenate(result)}
            yield pd.DataFrame(columns | {"spans": found} if spans else columns)
        give_back()

    return docs.withColumn(name, judge(F.col("text")))


def toxicity(docs: DataFrame, labelled: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, spans: bool = True) -> DataFrame:
    """Per row ``doc_id, held_out, score, predicted`` and, if asked for, ``spans``; the model is fitted on ``labelled`` and ``labels``."""
    judged = with_toxicity(docs.select("doc_id", "text"), fit_model(labelled, labels), spans=spans)
    return judged.select(
        "doc_id",
        F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("_tox.score").alias("score"),
        (F.col("_tox.score") >= threshold).cast("int").alias("predicted"),
        *[F.col("_tox.spans").alias("spans")] * spans,
    )


def drop_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below ``threshold``, all their columns unchanged."""
    judged = with_toxicity(docs, fit_model(labelled, labels), spans=False)
    return judged.where(F.col("_tox.score") < threshold).drop("_tox")
