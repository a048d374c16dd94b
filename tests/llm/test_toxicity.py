import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmart.llm.toxicity import chain_marginals, drop_toxic, fit, toxicity, with_toxicity

SCHEMA, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def test_marginals_agree_with_all_taggings():
    rng = np.random.default_rng(3)
    lengths = np.array([3, 0, 5, 1, 4])
    scores, chain, pairs = rng.normal(size=lengths.sum()), rng.normal(size=5), np.zeros(4)
    got, at, steps = chain_marginals(scores, lengths, chain, cells=8, pairs=pairs), 0, np.zeros(4)
    for n in lengths:
        own, total, ones = scores[at:at + n], 0.0, np.zeros(n)
        moves = np.zeros(4)
        for tags in itertools.product((0, 1), repeat=int(n)):
            value = sum(s for s, t in zip(own, tags) if t) + (chain[0] * tags[0] if n else 0)
            kinds = [2 * a + b for a, b in itertools.pairwise(tags)]
            weight = np.exp(value + sum(chain[1 + k] for k in kinds))
            total, ones = total + weight, ones + weight * np.array(tags)
            moves += weight * np.bincount(kinds, minlength=4)
        assert np.allclose(got[at:at + n], ones / total)
        steps += moves / total
        at += n
    assert np.allclose(pairs, steps)


def rows(n, seed=1):
    rng, vocab = random.Random(seed), [f"word{i}" for i in range(300)]
    out = []
    for i in range(n):
        words, bad = rng.choices(vocab, k=rng.randint(5, 40)), i % 3 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["badword", "vilething", "vilely"]))
        out.append((i, " ".join(words), int(bad)))
    return out


EDGE = [(1000, None), (1001, ""), (1002, "badword " * 60_000), (None, "vilely badword here"), (1003, "word1　badword.")]


@pytest.fixture(scope="module")
def tables(spark):
    data = rows(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + EDGE, SCHEMA)
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in data] + [(None, 0, 1), (5, None, None)], LABELS)
    return data, docs.selectExpr("*", "1 AS score", "'x' AS _toxic"), labels


def test_unseen_rows_are_told_apart(spark, tables):
    data, docs, labels = tables
    got = {r.doc_id: r for r in toxicity(docs, docs, labels).collect()}
    assert len(got) == len(data) + len(EDGE) and any(r.held_out for r in got.values())
    assert all(got[i].predicted == y for i, _, y in data if got[i].held_out)
    assert got[1000].score == got[1001].score < 0.3 and not got[1001].spans
    assert got[1002].predicted == got[None].predicted == 1 and len(got[1002].spans) == 60_000
    assert [(s.start, s.end) for s in got[1003].spans] == [(6, 14)]
    kept = {r.doc_id for r in drop_toxic(docs, docs, labels).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_held_out_labels_teach_nothing(spark, tables):
    data, docs, labels = tables
    held = {r.doc_id for r in toxicity(docs, docs, labels).where("held_out").collect()}
    turned = spark.createDataFrame([(i, 0, 1 - y if i in held else y) for i, _, y in data], LABELS)
    plain = {r.doc_id: r.score for r in toxicity(docs, docs, labels).collect()}
    assert plain == {r.doc_id: r.score for r in toxicity(docs, docs, turned).collect()}


def test_without_labels_or_rows(spark, tables):
    _, docs, labels = tables
    nothing = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity(docs, docs, nothing).collect()} == {0.0}
    assert toxicity(spark.createDataFrame([], SCHEMA), docs, labels).collect() == []


def test_one_class_and_repeats():
    model = fit(["a b c"] * 5, [0] * 5, [1.0] * 5)
    assert set(model) == {"field", "bias", "chain", "curve"}


def test_an_id_in_many_rows_is_fitted_once(spark):
    from parcelmart.llm.toxicity import fit_model

    data = rows(120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], SCHEMA)
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in data], LABELS)
    more = spark.range(300).selectExpr("4L AS doc_id", "concat('text ', id) AS text").unionByName(docs.where("doc_id = 4"))
    least = more.selectExpr("doc_id", "text").orderBy(F.xxhash64("text")).limit(1)
    once = fit_model(docs.where("doc_id != 4").unionByName(spark.createDataFrame(least.collect(), SCHEMA)), labels)
    assert once and fit_model(docs.where("doc_id != 4").unionByName(more), labels) == once


def test_samples_of_one_text():
    for i in range(60):
        for label in (0, 1):
            assert set(fit([f"word{i} and *some* more{i}"], [label], [1.0])) == {"field", "bias", "chain", "curve"}
