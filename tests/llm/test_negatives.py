import numpy as np
import pytest

from parcelmart.llm import negatives
from parcelmart.llm.negatives import RESULT, exact_scores, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, percent=80):
    fine = [
        (i, [int(np.floor(256 * float(x))) for x in v], lab)
        for i, v, lab in rows
        if None not in (i, v, lab) and all(x is not None and np.isfinite(x) for x in v)
    ]
    result = []
    for a, v, label in fine:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for i, w, lab in fine)
        for minus, p, _ in [x for x in scored if x[2] == label and x[1] != a][:5]:
            fits = [x for x in scored if x[2] != label and -percent * minus <= -100 * x[0] <= -100 * minus]
            result += [(a, p, r, n, -minus, -s) for r, (s, n, _) in enumerate(fits[:5], 1)]
    return sorted(result)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def sample(n, seed, width=9):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(3, width))
    return [(i, [float(np.float32(x)) for x in centre[i % 3] * 0.3 + rng.normal(size=width) * 0.2], int(rng.integers(3))) for i in range(n)]


EDGE = [
    (None, [1.0] * 9, 0), (901, None, 0), (902, [1.0] * 9, None), (903, [1.0, None] + [0.0] * 7, 0), (904, [float("nan")] * 9, 1),
    (905, [float("inf")] * 9, 1), (906, [], 2), (907, [0.5] * 4, 1), (908, [0.25] * 12, 2), (1000, [], 1), (1100, [0.5] * 30, 0),
]


def test_equals_brute_force(spark):
    rows = sample(400, 1) + EDGE + sample(400, 1)[:40] + [(300, [0.1] * 9, 2)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS anchor", "2 AS slot", "3 AS id", "4 AS score").repartition(5)
    found = got(hard_negatives(frame))
    assert found == brute(rows) and len(found) > 50


def test_many_blocks_and_small_steps(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_CELLS", 20)
    monkeypatch.setattr(negatives, "SCORE_CELLS", 64)
    rows = sample(90, 2)
    assert got(hard_negatives(spark.createDataFrame(rows, SCHEMA), anchor_every=10)) == brute(rows, 10)


def test_ties_and_window_edges(spark):
    one = 1 / 256
    rows = [(0, [10 * one], 0), (1, [10 * one], 0)] + [(2 + i, [x * one], 1) for i, x in enumerate([8, 10, 10, 7.99, 11, 9, 10, 8, 10, 10])]
    found = got(hard_negatives(spark.createDataFrame(rows, SCHEMA)))
    assert [r[3] for r in found] == [3, 4, 8, 10, 11] and found == brute(rows)
    assert got(hard_negatives(spark.createDataFrame(rows[:5], SCHEMA), percent=100)) == brute(rows[:5], percent=100)


def test_one_label_no_anchor_and_empty(spark):
    same = [(i, [0.5, 0.5], 1) for i in range(0, 300, 100)]
    for rows in (same, [(1, [0.5], 1), (2, [0.5], 2)], []):
        frame = hard_negatives(spark.createDataFrame(rows, SCHEMA))
        assert frame.collect() == [] and frame.schema == spark.createDataFrame([], RESULT).schema


def test_scores_are_exact_at_any_size():
    rng = np.random.default_rng(5)
    for size, width in ((3, 1), (200, 64), (2**20, 300), (2**27, 500), (2**29, 30)):
        left, right = (rng.integers(-size, size + 1, (n, width)) for n in (7, 11))
        exact = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in right] for a in left]
        assert exact_scores(left.astype(float), right.astype(float)).tolist() == exact
    worst = np.full((1, 2000), 254.0)
    assert exact_scores(worst, -worst).tolist() == [[-2000 * 254 * 254]]
    with pytest.raises(ValueError, match="64 bits"):
        exact_scores(np.full((1, 4), 2.0**40), np.full((1, 4), 2.0**40))
