import hashlib
import random
from collections import Counter

import pytest

from parcelmart.llm.phrases import drop_repeats, substring_removal

SCHEMA = "doc_id long, text string"


def brute(rows, length=35):
    split = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def make(seed=5):
    rng = random.Random(seed)
    say = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    shared, hot, edge = say(90), say(50), say(35)
    rows = [(None, None), (0, ""), (0, " \t\n"), (1, " ".join(say(34))), (2, "same " * 34), (3, "same " * 35), (4, "same " * 36)]
    rows += [(5, " ".join(say(5) + shared + say(5))), (6, " ".join(shared[10:70] + say(40))), (7, "\n".join(shared))]
    rows += [(8, " ".join(say(20) + edge + say(9))), (9, " ".join(edge)), (10, " ".join(edge[:-1] + ["x"])), (11, "été　a " * 40)]
    twice = say(60)
    rows += [(12, " ".join(twice + say(7) + twice)), (13, "copy " + " ".join(say(50)))] * 1 + [(14, " ".join(say(30_000)))]
    rows += [(i, " ".join(say(rng.randrange(30)) + hot + say(rng.randrange(30)))) for i in range(100, 160)]
    copy = " ".join(say(60))
    return rows + [(200, copy), (201, copy), (200, copy), (None, copy)]


def test_agrees_with_brute_force(spark):
    rows = make()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS anchor", "'x' AS words", "3 AS kept", "4 AS met")
    assert sorted((tuple(r) for r in substring_removal(docs).collect()), key=str) == brute(rows)


def test_small_shards_split_hot_anchors(spark, monkeypatch):
    import parcelmart.llm.phrases as phrases

    monkeypatch.setattr(phrases.repeated_spans, "__defaults__", (phrases.LENGTH, phrases.INNER, 7))
    rows = make(6)
    got = substring_removal(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_untouched_rows_and_emptied_documents(spark):
    rows = make()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "cast(length(text) AS long) n_chars", "2 AS spans")
    got = drop_repeats(docs).collect()
    judged = brute(rows)
    emptied = [r for r in judged if r[1] and r[1] == r[2]]
    assert emptied and len(got) == len(rows) - len(emptied)
    clean = {r[0] for r in judged if not r[2]}
    texts = dict(rows)
    assert all(r.text == texts[r.doc_id] for r in got if r.doc_id in clean and r.doc_id)
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)


@pytest.mark.parametrize("rows", [[], [(1, "a b c")], [(1, None)]])
def test_nothing_recurs(spark, rows):
    got = substring_removal(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.n_removed for r in got] == [0] * len(rows)
