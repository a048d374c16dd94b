import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from parcelmart.plans import late_model, risk_views
from parcelmart.plans.features import CATEGORICAL_FEATURES, FEATURES, cut_dates, prepared, split_by_time, split_sizes
from parcelmart.plans.late_model import fit_and_measure, run_late_model
from parcelmart.plans.load import run_load
from parcelmart.sources.files import child_names
from parcelmart.sources.published import PublishedTables
from tests import rows

COLUMNS = ["order_id", "purchase_date", "is_late", *FEATURES]


def feature_rows(n=3000, seed=7):
    """Late depends on the customer's state and the weight, with some noise."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        row = dict.fromkeys(FEATURES, 1)
        row.update(
            order_id=f"o{i:05d}", purchase_date=date(2018, 1, 1) + timedelta(days=i * 200 // n),
            customer_state=rng.choice(["SP", "RJ", "AM"]), seller_state="SP", payment_type=rng.choice(["boleto", None]),
            main_category=rng.choice(["books", "toys"]), total_weight_g=rng.choice([None, 100.0, 5000.0]),
            freight_ratio=rng.random(), total_volume_cm3=rng.random() * 1000,
        )
        risk = 0.05 + 0.5 * (row["customer_state"] == "AM") + 0.3 * (row["total_weight_g"] == 5000.0)
        row["is_late"] = None if i % 50 == 0 else int(rng.random() < risk)
        out.append(tuple(row[c] for c in COLUMNS))
    return out


def feature_frame(spark, data):
    kinds = {"order_id": "string", "purchase_date": "date", "is_late": "int", **dict.fromkeys(CATEGORICAL_FEATURES, "string")}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in COLUMNS)
    return spark.createDataFrame([tuple(float(v) if kinds.get(c) is None and v is not None else v for c, v in zip(COLUMNS, r, strict=True)) for r in data], schema)


def test_prepared_coerces_numbers_and_fills_categories(spark):
    frame = feature_frame(spark, feature_rows(20)).withColumn("n_items", F.lit("three"))
    row = prepared(frame).first()
    assert row.n_items is None
    assert prepared(frame).where(F.col("payment_type").isNull()).count() == 0
    assert prepared(frame).where(F.col("payment_type") == "unknown").count() > 0


def test_cut_dates_are_those_of_the_sorted_positions(spark):
    data = feature_rows(1290)
    labelled = sorted(r[1] for r in data if r[2] is not None)
    cuts = cut_dates(feature_frame(spark, data)).first()
    assert cuts.labelled == len(labelled)
    assert cuts.valid_from == labelled[int(len(labelled) * 0.70)]
    assert cuts.test_from == labelled[int(len(labelled) * (0.70 + 0.15))]


def test_a_day_is_never_divided(spark):
    data = [("a", date(2018, 1, 1), 0)] * 60 + [("b", date(2018, 1, 2), 1)] * 30 + [("c", date(2018, 1, 3), 1)] * 10
    frame = spark.createDataFrame([*data, ("d", date(2018, 1, 9), None)], "order_id string, purchase_date date, is_late int")
    sizes = {r.data_split: (r.orders, r.late) for r in split_sizes(split_by_time(frame)).collect()}
    # Position 70 and position 85 both fall on the second day: nothing is left for validation.
    assert sizes == {"train": (60, 0), "test": (40, 40), "open": (1, None)}


def test_risk_level_compares_the_rounded_score_with_the_exact_threshold(spark):
    frame = spark.createDataFrame(
        [("t", "test", date(2018, 1, 1), 1, 0.50004), ("o", "open", date(2018, 1, 1), None, 0.50006)],
        "order_id string, data_split string, purchase_date date, is_late int, probability double",
    )
    got = {r.order_id: (float(r.late_probability), r.risk_level, r.actual_is_late) for r in risk_views.predictions(frame, 0.50004).collect()}
    assert got == {"t": (0.5, "normal", True), "o": (0.5001, "high", None)}


def test_scores_are_stored_half_to_even(spark):
    frame = spark.createDataFrame([(0.03125,), (0.09375,)], "p double")
    assert [r[0] for r in frame.select(risk_views.stored_probability(F.col("p"))).collect()] == [0.0312, 0.0938]


def test_the_model_finds_the_planted_signal_and_repeats(spark):
    first, second = (fit_and_measure(feature_frame(spark, feature_rows()), max_trees=15) for _ in range(2))
    assert first.metrics["roc_auc"] > 0.7 and first.metrics["lift"] > 1.5
    assert first.metrics["pr_auc"] > first.metrics["baseline_pr_auc"]
    assert {name for name, _ in first.importance[:2]} == {"customer_state", "total_weight_g"}
    assert sum(share for _, share in first.importance) == pytest.approx(100)
    assert first.metrics == second.metrics and first.threshold == second.threshold
    assert first.scored.where("data_split = 'open'").count() == 60
    assert first.scored.where("probability < 0 or probability > 1").count() == 0


@pytest.fixture(scope="module")
def small_warehouse(spark, tmp_path_factory):
    rng, orders = random.Random(3), []
    for i in range(1300):
        day = date(2018, 1, 1) + timedelta(days=i // 10)
        late = rng.random() < 0.3
        done = "" if i % 100 == 0 else f"{day + timedelta(days=30 if late else 5)} 00:00:00"
        orders.append(rows.order(f"o{i}", f"{day} 10:00:00", "delivered" if done else "shipped", delivered=done, estimated=f"{day + timedelta(days=20)} 00:00:00"))
    root = str(tmp_path_factory.mktemp("model"))
    run_load(spark, root, rows.sources(spark, orders, items=[rows.line(o["order_id"], 1) for o in orders]))
    return root


def test_a_model_run_stores_record_importance_and_predictions(spark, small_warehouse):
    reports = [run_late_model(spark, small_warehouse, max_trees=2) for _ in range(2)]
    counts = [{r.table_name: (r.inserted, r.updated, r.deleted) for r in report.collect()} for report in reports]
    tables = PublishedTables(spark, small_warehouse)
    latest = tables.latest()
    predictions = tables.read(latest, "ml/order_late_predictions")
    n = predictions.count()
    assert counts[0]["ml.order_late_predictions"] == (n, 0, 0) and counts[1]["ml.order_late_predictions"] == (n, 0, n)
    assert counts[1]["ml.model_runs"] == (1, 0, 0) and counts[1]["ml.feature_importance"] == (17, 0, 0)
    runs = tables.read(latest, "ml/model_runs").orderBy("run_id").collect()
    assert len(runs) == 2 and runs[0].run_id != runs[1].run_id
    assert runs[1].train_rows + runs[1].valid_rows + runs[1].test_rows == 1287
    assert {r.run_id for r in predictions.select("run_id").distinct().collect()} == {runs[1].run_id}
    assert tables.read(latest, "core/fact_orders").count() == 1300
    assert len(child_names(spark, f"{small_warehouse}/ml/models")) == 2


def test_a_failed_store_leaves_no_model_behind(spark, small_warehouse, monkeypatch):
    before = PublishedTables(spark, small_warehouse).latest().run_id
    models = child_names(spark, f"{small_warehouse}/ml/models")

    def broken(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(late_model, "predictions", broken)
    with pytest.raises(RuntimeError, match="disk full"):
        run_late_model(spark, small_warehouse, max_trees=1)
    assert PublishedTables(spark, small_warehouse).latest().run_id == before
    assert child_names(spark, f"{small_warehouse}/ml/models") == models


@pytest.mark.parametrize(
    ("losses", "patience", "kept"),
    [([3, 2, 2.5, 1, 4], 50, 4), ([3, 2, 2.5, 2.6, 1], 2, 2), ([1], 50, 1), ([5, 5, 5], 50, 1), ([3, 2, 4, 1, 4, 4, 0], 2, 4)],
)
def test_the_prefix_before_patience_ran_out_is_kept(losses, patience, kept):
    assert late_model.best_prefix(losses, patience) == kept
