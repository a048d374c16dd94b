import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelmart.plans.load import csv_sources
from parcelmart.sources.files import child_names
from parcelmart.sources.published import PublishedTables
from parcelmart.sources.staging import read_csv, typed
from tests import rows


def test_missing_files_stop_before_reading(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("x")
    with pytest.raises(FileNotFoundError, match="sellers.csv"):
        csv_sources(spark, {"orders": f"{tmp_path}/orders.csv", "sellers": f"{tmp_path}/sellers.csv"})


def test_quotes_commas_and_line_breaks_stay_in_their_field(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        '"review_id","order_id","review_score","review_comment_title","review_comment_message",'
        '"review_creation_date","review_answer_timestamp"\n'
        '"r1","o1","5","","a ""q"" b\nline2, x","2018-01-01 00:00:00",""\n'
        'r2,o2,4,,olá,2018-01-01 00:00:00,2018-01-02 10:11:12\n',
        encoding="utf-8",
    )
    read = {r.review_id: r for r in typed("order_reviews", read_csv(spark, "order_reviews", str(path))).collect()}
    assert read["r1"].review_comment_message == 'a "q" b\nline2, x'
    assert read["r1"].review_answer_timestamp is None
    assert read["r2"].review_comment_message == "olá"
    assert str(read["r2"].review_answer_timestamp) == "2018-01-02 10:11:12"


def test_a_row_with_too_few_fields_is_an_error(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1\n")
    with pytest.raises((PySparkException, Py4JError)):
        read_csv(spark, "sellers", str(path)).collect()


def test_malformed_values_are_errors_and_empty_ones_null(spark):
    good = rows.table(spark, "orders", [rows.order("o1", "2018-01-01 10:00:00")])
    row = typed("orders", good).first()
    assert row.order_approved_at is None and str(row.order_purchase_timestamp) == "2018-01-01 10:00:00"
    bad = rows.table(spark, "orders", [rows.order("o1", "01/02/2018 x")])
    with pytest.raises((PySparkException, Py4JError)):
        typed("orders", bad).collect()
    with pytest.raises((PySparkException, Py4JError)):
        typed("order_items", rows.table(spark, "order_items", [rows.line("o1", "one")])).collect()


def test_versions_are_invisible_until_published(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path))
    assert tables.latest().run_id == 0
    first = tables.draft()
    tables.write(first, "a", spark.range(3))
    assert tables.latest().run_id == 0
    tables.publish(first)
    second = tables.draft()
    tables.append(second, "a", spark.range(2))
    assert tables.read(tables.latest(), "a").count() == 3
    assert tables.read(second, "a").count() == 5
    third = tables.draft()
    tables.publish(third)
    with pytest.raises(RuntimeError, match="overtaken"):
        tables.publish(second)


@pytest.mark.parametrize("order", [("load", "model"), ("model", "load"), ("load", "load")])
def test_a_draft_from_an_older_version_is_refused(spark, tmp_path, order):
    tables = PublishedTables(spark, str(tmp_path))
    base = tables.draft()
    tables.write(base, "core", spark.range(1))
    tables.publish(base)
    drafts = [tables.draft() for _ in order]
    for draft, kind in zip(drafts, order, strict=True):
        tables.append(draft, {"load": "core", "model": "ml"}[kind], spark.range(4))
    tables.publish(drafts[1])  # begun later, published first
    with pytest.raises(RuntimeError, match="overtaken"):
        tables.publish(drafts[0])
    assert tables.read(tables.latest(), "core").count() == (5 if order[1] == "load" else 1)


def test_two_writers_of_one_number_cannot_both_win(spark, tmp_path, monkeypatch):
    tables = PublishedTables(spark, str(tmp_path))
    drafts = [tables.draft(), tables.draft()]
    old = tables.latest()
    monkeypatch.setattr(tables, "latest", lambda: old)  # both looked before either wrote
    tables.publish(drafts[1])
    with pytest.raises(RuntimeError, match="overtaken"):
        tables.publish(drafts[0])


def test_expired_versions_free_their_folders_but_shared_ones_stay(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path))
    frame = spark.range(6).select("id", (F.col("id") % 3).cast("int").alias("part"))
    for run, replaced in enumerate([set(), {0}, {0, 1}]):
        version = tables.draft()
        rows_now = frame.where(F.col("part").isin(*replaced)) if replaced else frame
        tables.write_parts(version, "t", rows_now, "part", replaced)
        tables.write(version, "whole", spark.range(run + 1))
        tables.publish(version)
    tables.draft()  # a run that has begun
    tables.write(tables.draft(), "whole", spark.range(9))
    tables.expire(1)
    assert child_names(spark, f"{tmp_path}/whole") == ["run=3", "run=5"]
    assert child_names(spark, f"{tmp_path}/t") == ["run=1", "run=3"]
    assert [n for n in child_names(spark, f"{tmp_path}/t/run=1") if "=" in n] == ["part=2"]
    assert tables.read(tables.latest(), "t").count() == 6


def test_parts_that_are_not_replaced_keep_their_folder(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path))
    first = tables.draft()
    frame = spark.range(10).select("id", (F.col("id") % 3).cast("int").alias("part"))
    tables.write_parts(first, "t", frame, "part", set())
    tables.publish(first)
    second = tables.draft()
    replacement = spark.range(100, 102).select("id", F.lit(1).alias("part"))
    merged = tables.write_parts(second, "t", replacement, "part", {1})
    assert sorted(r.id for r in merged.collect()) == [0, 2, 3, 5, 6, 8, 9, 100, 101]
    assert {f.split("/")[1] for f in second.folders["t"]} == {"run=1", "run=2"}
    third = tables.draft()
    emptied = tables.write_parts(third, "t", replacement.limit(0), "part", {0, 1, 2})
    assert emptied.count() == 0 and emptied.columns == ["id", "part"]
