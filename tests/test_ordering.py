import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmart.operators.ordering import quantile, quantiles, with_ntile, with_row_number, with_running_totals
from parcelmart.operators.ranking import alert_quality, ranking_quality


def scores(seed, n, hot=0.4):
    """Scores with one value that holds a large share of the rows."""
    rng = random.Random(seed)
    return [(i, 0.5 if rng.random() < hot else round(rng.random(), 3), int(rng.random() < 0.3)) for i in range(n)]


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "id bigint, score double, late int").repartition(5)


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_row_numbers_follow_the_total_order(spark, n):
    rows = scores(1, n)
    numbered = with_row_number(frame_of(spark, rows), F.col("score").desc(), F.col("id")).collect()
    expected = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert {r.id: r.row_number for r in numbered} == expected
    assert all(r.row_count == n for r in numbered)


@pytest.mark.parametrize("n", [3, 10, 14, 997])
def test_ntile_gives_the_first_buckets_one_row_more(spark, n):
    rows = scores(2, n)
    got = {r.id: r.bucket for r in with_ntile(frame_of(spark, rows), 10, F.col("score"), F.col("id")).collect()}
    ordered = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    sizes = [n // 10 + (i < n % 10) for i in range(10)]
    expected = dict(zip(ordered, [b + 1 for b, size in enumerate(sizes) for _ in range(size)], strict=True))
    assert got == expected


def test_running_totals(spark):
    rows = scores(3, 500)
    out = with_running_totals(frame_of(spark, rows), [F.col("score"), F.col("id")], {"upto": "late"}).collect()
    total, expected = 0, {}
    for row in sorted(rows, key=lambda r: (r[1], r[0])):
        total += row[2]
        expected[row[0]] = total
    assert {r.id: r.upto for r in out} == expected


@pytest.mark.parametrize("fraction", [0.0, 0.37, 0.9, 1.0])
def test_quantile_interpolates_like_numpy(spark, fraction):
    rows = scores(4, 777)
    got = quantile(frame_of(spark, rows), "score", fraction).first()[0]
    assert got == pytest.approx(np.quantile([r[1] for r in rows], fraction), abs=1e-12)


def test_quantile_of_four_values(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    assert quantile(frame, "v", 0.9).first()[0] == pytest.approx(3.7)


def brute_force_quality(rows):
    positives = [s for _, s, late in rows if late]
    negatives = [s for _, s, late in rows if not late]
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    precision_sum, caught, seen = 0.0, 0, 0
    for value in sorted({s for _, s, _ in rows}, reverse=True):
        here = [late for _, s, late in rows if s == value]
        caught, seen = caught + sum(here), seen + len(here)
        precision_sum += sum(here) * caught / seen
    return won / len(positives) / len(negatives), precision_sum / len(positives)


def test_ranking_quality_against_the_definitions(spark):
    rows = scores(5, 400)
    got = ranking_quality(frame_of(spark, rows), "score", "late").first()
    auc, precision = brute_force_quality(rows)
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)
    assert got.pr_auc == pytest.approx(precision, abs=1e-12)
    assert (got.positives, got.rows) == (sum(r[2] for r in rows), 400)


def test_ranking_quality_depends_on_order_only(spark):
    frame = frame_of(spark, scores(6, 300))
    stretched = frame.withColumn("score", F.exp(F.col("score") * 3))
    assert ranking_quality(frame, "score", "late").first().roc_auc == pytest.approx(
        ranking_quality(stretched, "score", "late").first().roc_auc, abs=1e-12
    )


def test_alert_quality(spark):
    frame = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.3, 1), (0.1, 0)], "score double, late int")
    row = alert_quality(frame, "score", "late", 0.8).first().asDict()
    assert row == {
        "late_rate": 0.5, "baseline_pr_auc": 0.5, "flagged_pct": 0.5, "flagged_precision": 0.5,
        "flagged_recall": 0.5, "lift": 1.0,
    }
    nothing = alert_quality(frame, "score", "late", 2.0).first()
    assert (nothing.flagged_precision, nothing.flagged_recall, nothing.lift) == (0.0, 0.0, 0.0)


def test_many_quantiles_share_the_passes(spark):
    draw = random.Random(8)
    values = [draw.choice([-1e300, 1e300, 0.0, 5e-324, draw.gauss(0, 1), draw.gauss(1e9, 1e-3), 7.5]) for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(4)
    fractions = {f"q{i}": i / 20 for i in range(21)}
    got = quantiles(frame, "v", fractions).first().asDict()
    ordered = sorted(values)
    for name, fraction in fractions.items():
        place = (len(ordered) - 1) * fraction
        low, high = ordered[int(place)], ordered[min(int(place) + 1, len(ordered) - 1)] if place % 1 else ordered[int(place)]
        assert got[name] == low + (high - low) * (place - int(place))
    assert quantiles(frame.where("v IS NULL"), "v", {"q": 0.5}).first().q is None
