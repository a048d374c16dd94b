import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from parcelmart.llm.packing import LIMIT
from tests.llm.test_toxicity import LABELS, SCHEMA, rows

RNG = random.Random(3)


def say(n):
    return [f"{RNG.choice('bcdfg')}{RNG.randrange(10**6)}x" for _ in range(n)]


def planted():
    """Near copies on both sides of 0.8, recurring passages, benchmark windows of ten and of nine words."""
    text, passage, item = say(60), say(40), say(12)
    one, three = list(text), list(text)
    one[30] = "other"
    three[15] = three[30] = three[45] = "another"
    return [
        (1000, text), (1001, one), (1002, three), (1003, text),
        (1010, say(5) + item[1:11] + say(5)), (1011, say(5) + item[:9] + say(5)), (1012, say(20)),
        (1020, say(60) + passage + say(40)), (1021, say(50) + passage + say(70)), (1022, passage),
    ], [(1, item)]


DATA = rows(400)
PLANTED, BENCHMARK = planted()
DOCS = {**{i: t.split() for i, t, _ in DATA}, **dict(PLANTED)}
TOXIC = {i for i, _, y in DATA if y}


def without_toxic(docs):
    return {i: w for i, w in docs.items() if i not in TOXIC}


def without_near_copies(docs, size=5, likeness=80):
    sets = {i: {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} for i, w in docs.items()}
    group = {i: i for i in docs}
    for a, b in combinations(sorted(docs), 2):
        if 100 * len(sets[a] & sets[b]) >= likeness * len(sets[a] | sets[b]):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {i: new if g == old else g for i, g in group.items()}
    return {i: docs[i] for i in set(group.values())}


def without_repeats(docs, length=35):
    seen = Counter(tuple(w[j : j + length]) for w in docs.values() for j in range(len(w) - length + 1))
    out = {}
    for i, w in docs.items():
        gone = {p for j in range(len(w) - length + 1) if seen[tuple(w[j : j + length])] > 1 for p in range(j, j + length)}
        if left := [x for p, x in enumerate(w) if p not in gone]:
            out[i] = left
    return out


def without_benchmark(docs, n=10):
    windows = {tuple(w[j : j + n]) for _, w in BENCHMARK for j in range(len(w) - n + 1)}
    return {i: w for i, w in docs.items() if not any(tuple(w[j : j + n]) in windows for j in range(len(w)))}


BRUTE = [without_toxic, without_near_copies, without_repeats, without_benchmark]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    tables = {
        "documents": ([(i, " ".join(w)) for i, w in DOCS.items()], SCHEMA),
        "labels": ([(i, 0, y) for i, _, y in DATA], LABELS),
        "benchmark": ([(i, " ".join(w)) for i, w in BENCHMARK], "item_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def test_planted_rows_meet_every_stage():
    for stage in BRUTE:
        assert stage(DOCS) != DOCS
    assert {1000, 1002} <= set(without_near_copies(DOCS)) and not {1001, 1003} & set(without_near_copies(DOCS))


@pytest.mark.parametrize("number", range(4))
def test_each_stage_against_brute_force(spark, folder, number):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.STAGES[number][1](spark, docs, folder).collect()
    assert {r.doc_id: r.text.split() for r in got} == BRUTE[number](DOCS)


def test_run_takes_all_stages_in_order(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "repeats", "benchmark", "packing"]
    docs = DOCS
    for stage in BRUTE:
        docs = stage(docs)
    tokenizer, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for i, words in docs.items():
        ids = np.array([*tokenizer.encode(" ".join(words), add_special_tokens=False).ids, 0], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), LIMIT)):
            part = ids[at : at + LIMIT]
            expected[i, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
