"""Queries that must cover the whole of their tables."""

import os

import pytest

import __spark_entry__ as entry  # noqa: F401  (registers the queries)
from parcelqueries.compare import connect, difference
from parcelqueries.registry import QUERIES
from parcelmart.sources.staging import COLUMNS, text_schema
from parcelqueries import load_queries, mapping, run_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_order_has_a_bucket(spark, duck):
    wrong, _ = difference(spark, duck, FOLDER, "w13_ntile_over_all_orders")
    assert wrong is None
    got = QUERIES["w13_ntile_over_all_orders"](spark, FOLDER).collect()
    keys = [r.o_orderkey for r in spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey").collect()]
    assert sorted(int(r.order_id) for r in got) == sorted(keys)
    assert {r.bucket for r in got if int(r.order_id) % 89 == 0} == {10}


def test_all_prepared_columns(spark, duck):
    wrong, rows = difference(spark, duck, FOLDER, "l2_all_prepared_features")
    assert wrong is None and rows
    assert len(QUERIES["l2_all_prepared_features"](spark, FOLDER).columns) == 20


@pytest.mark.parametrize("table", list(COLUMNS))
def test_each_file_with_all_columns(spark, duck, table):
    wrong, rows = difference(spark, duck, FOLDER, f"s1_csv_whole_{table}")
    assert wrong is None and rows
    assert QUERIES[f"s1_csv_whole_{table}"](spark, FOLDER).columns == list(COLUMNS[table])


def test_lines_that_a_second_snapshot_lost(spark, duck):
    wrong, rows = difference(spark, duck, FOLDER, "j8_lines_lost_between_snapshots")
    assert wrong is None and rows


def test_only_the_files_asked_for_are_written(spark, monkeypatch):
    built = []
    monkeypatch.setattr(load_queries, "_once", lambda kind, spark, folder, build: built.append(kind) or load_queries.scratch_path(spark, kind))
    monkeypatch.setattr(load_queries, "csv_sources", lambda spark, paths: dict.fromkeys(paths, spark.createDataFrame([], text_schema("sellers"))))
    QUERIES["s1_csv_whole_sellers"](spark, FOLDER)
    assert built == ["csv-sellers"]


def test_lines_meet_their_orders_without_another_shuffle(spark):
    """The shuffle that numbers the lines is by the id they are joined on, and carries the given columns only."""
    given = mapping.Given(spark, FOLDER)
    orders = mapping.orders(given).select("order_id").hint("merge")
    lines = mapping.order_items(given).join(orders, "order_id", "left_semi")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == plan.count("Exchange ") == 2
    below = plan[plan.index("Window") :]
    carried = below[below.index("Project [") : below.index("FileScan")]
    assert "decimal" not in carried and "l_returnflag" not in carried


def test_the_second_model_run_grows_all_trees(spark, monkeypatch):
    """Both runs of the query train as a run outside it does: with its own limit of trees."""
    given = []

    def run(spark, root, **settings):
        given.append(settings)
        return spark.range(1)

    monkeypatch.setattr(run_queries, "run_load", lambda *_, **__: None)
    monkeypatch.setattr(run_queries.late_model, "run_late_model", run)
    monkeypatch.setattr(run_queries, "_once", lambda kind, spark, folder, build: (root := load_queries.scratch_path(spark, kind), build(root))[0])
    assert QUERIES["s8_second_model_run"](spark, FOLDER).count() == 1
    assert given == [{}, {}]
