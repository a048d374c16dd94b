import hashlib
import re

import pytest

from parcelmart.llm.decontaminate import contamination, cut_contaminated, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, n=10):
    rows = []
    for doc_id, text in docs:
        w, hit, items = words_of(text), set(), set()
        for item, passage in bench:
            g = words_of(passage)
            k = min(n, len(g))
            grams = {tuple(g[i:i + k]) for i in range(len(g) - k + 1)} if g else set()
            for i in range(len(w) - k + 1):
                if k and tuple(w[i:i + k]) in grams:
                    hit |= set(range(i, i + k))
                    items.add(str(item))
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        rows.append((doc_id, len(w), len(hit), len(items), digest, bool(hit)))
    return sorted(rows, key=str)


P = " ".join(f"p{i}" for i in range(25))
BENCH = [(1, P), (10, "Été ÀB short"), (2, P), (3, None), (4, " ., "), (5, "solo")]
DOCS = [
    (1, "x " * 3 + P.upper().replace(" ", "--") + " y"), (2, " ".join(f"p{i}" for i in range(12)) + " z p13"),
    (3, None), (4, ""), (5, "étÉ"), (6, "été Àb SHORT end"), (7, "Été Àb SHORT, Été Àb SHORT"), (8, "a solo b solo"),
    (9, "w" * 50_000 + " " + "q r s t " * 30_000 + P), (None, "solo"), (8, "a solo b solo"), (8, "other"),
]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_agrees_with_brute_force(spark):
    docs = frame(spark, DOCS, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS hash", "3 AS spans")
    bench = frame(spark, BENCH, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS window")
    got = [tuple(r)[:6] for r in contamination(docs, bench).collect()]
    assert sorted(got, key=str) == brute(DOCS, BENCH)


@pytest.mark.parametrize("bound", [500_000, 0])
def test_removal_leaves_clean_rows_alone(spark, bound):
    docs, bench = frame(spark, DOCS, "doc_id long, text string"), frame(spark, BENCH, "item_id long, text string")
    clean = {r[:2] for r in DOCS if not brute([r], BENCH)[0][5]}
    assert {tuple(r) for r in drop_contaminated(docs, bench).collect()} == clean
    cut = {(r.doc_id, r.text) for r in cut_contaminated(docs, bench).collect()}
    assert clean < cut and (1, "x x x y") in cut and (8, "a b") in cut


def test_empty_tables(spark):
    none_d, none_b = frame(spark, [], "doc_id long, text string"), frame(spark, [], "item_id long, text string")
    assert contamination(none_d, frame(spark, BENCH, "item_id long, text string")).count() == 0
    assert contamination(frame(spark, DOCS, "doc_id long, text string"), none_b).where("contaminated").count() == 0
