import pytest

from parcelmart.operators import checks
from parcelmart.operators.checks import CheckFailed
from parcelmart.plans.features import require_trainable


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (3, "x")], "k int, v string")


def test_duplicate_keys(frame):
    assert [tuple(r) for r in checks.duplicate_keys(frame, "k").collect()] == [(2, 2)]
    checks.require_none(checks.duplicate_keys(frame, "k", "v"), "fine")
    with pytest.raises(CheckFailed, match="k repeats.*'k': 2"):
        checks.require_none(checks.duplicate_keys(frame, "k"), "k repeats")


def test_orphans_skip_null(spark, frame):
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [r.missing_key for r in checks.orphan_keys(frame, "v", parent, "id").collect()] == ["x"]


def test_nulls(frame):
    assert checks.null_counts(frame, "k", "v").first().asDict() == {"k": 0, "v": 1}
    checks.require_no_nulls(frame, "k")
    with pytest.raises(CheckFailed, match="'v': 1"):
        checks.require_no_nulls(frame, "k", "v")


def test_key_and_nulls_in_one_pass(spark, frame):
    checks.require_keyed(frame.where("k <> 2"), ["k"], ["v"], "t")
    checks.require_keyed(frame.limit(0), ["k"], ["v"], "t")
    with pytest.raises(CheckFailed, match="t: k repeats"):
        checks.require_keyed(frame, ["k"], [], "t")
    with pytest.raises(CheckFailed, match="t: null"):
        checks.require_keyed(frame, ["k", "v"], ["v"], "t")


def test_domain(frame):
    assert [tuple(r) for r in checks.outside_domain(frame, "v", ["a", "b"]).collect()] == [("x", 1)]


def test_counts(frame):
    assert checks.require_keyed(frame, ["k", "v"], [], "t") == 4
    checks.require_same_count(4, 4, "same")
    with pytest.raises(CheckFailed, match="4 staged but 1 loaded"):
        checks.require_same_count(4, 1, "lines")


def test_training_needs_enough_answers_and_late_orders():
    require_trainable({"train": (900, 5), "valid": (60, 1), "test": (40, 1), "open": (3, 0)})
    with pytest.raises(CheckFailed, match="only 999"):
        require_trainable({"train": (899, 5), "valid": (60, 1), "test": (40, 1), "open": (300, 0)})
    with pytest.raises(CheckFailed, match="test set"):
        require_trainable({"train": (900, 5), "valid": (60, 1), "test": (40, 0)})
    with pytest.raises(CheckFailed, match="valid set"):
        require_trainable({"train": (960, 5), "test": (40, 1)})


def test_parents_keys_are_never_sent_whole(spark):
    """Files pack keys so well that millions of them look small; they would all pass through the driver."""
    child = spark.createDataFrame([(1,), (1,), (2,), (7,), (None,)], "key long")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    found = checks.orphan_keys(child, "key", parent, "id")
    assert [r.missing_key for r in found.collect()] == [7]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
