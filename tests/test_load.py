from datetime import UTC, datetime

import pytest

from parcelmart.operators.checks import CheckFailed
from parcelmart.plans import facts as facts_plan
from parcelmart.plans import load
from parcelmart.plans.batch import seed_watermark, select_batch
from parcelmart.plans.load import core_tables, run_load
from parcelmart.sources.published import PublishedTables
from tests import rows
from tests.rows import customer, line, payment, review

FIRST, SECOND, THIRD = (datetime(2018, month, 1, tzinfo=UTC) for month in (3, 4, 5))



def order(*args, **kwargs):
    return rows.order(*args, **{"estimated": "2018-06-01 00:00:00", **kwargs})


ORDERS = [
    order("same", "2017-12-05 08:00:00", delivered="2018-01-15 00:00:00"),
    order("moved", "2018-01-06 08:00:00", status="shipped", carrier="2018-01-08 00:00:00"),
    order("status", "2018-02-01 08:00:00", status="shipped"),
    order("vanished", "2018-02-02 08:00:00"),
    order("newest", "2018-02-20 08:00:00"),
]
LINES = [line("same", 1), line("same", 2), line("moved", 1), line("moved", 2, "p2"), line("vanished", 1), line("newest", 1)]


def first_snapshot(spark):
    return rows.sources(spark, ORDERS, items=LINES, payments=[payment("moved", 1)], reviews=[review("same", 3)])


def second_snapshot(spark):
    """One order delivered since, one canceled without a new time, one gone, one new, one line less in two orders."""
    orders = [
        ORDERS[0],
        order("moved", "2018-01-06 08:00:00", carrier="2018-01-08 00:00:00", delivered="2018-03-20 00:00:00"),
        order("status", "2018-02-01 08:00:00", status="canceled"),
        ORDERS[4],
        order("fresh", "2018-03-05 08:00:00"),
    ]
    lines = [line("same", 1), line("moved", 1, price="11.00"), line("newest", 1), line("fresh", 1, "p9", "s2")]
    products = [*rows.PRODUCTS, {"product_id": "p9"}]
    return rows.sources(spark, orders, items=lines, payments=[payment("moved", 1, value="99.00")], products=products)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    results = [
        run_load(spark, root, first_snapshot(spark), run_ts=FIRST),
        run_load(spark, root, second_snapshot(spark), run_ts=SECOND),
    ]
    return root, results


def facts(spark, root):
    core = core_tables(spark, root)
    return {r.order_id: r for r in core["fact_orders"].collect()}, core


def test_first_load_takes_everything(loaded):
    _, (first, _) = loaded
    assert (first.rows_new, first.rows_changed) == (5, 0)
    assert first.rows_loaded["order_items"] == 6 and first.rows_loaded["order_reviews"] == 1


def test_second_load_takes_new_and_changed_orders(spark, loaded):
    root, (_, second) = loaded
    assert (second.rows_new, second.rows_changed) == (1, 2)
    orders, core = facts(spark, root)
    assert set(orders) == {"same", "moved", "status", "vanished", "newest", "fresh"}
    assert orders["moved"].order_status == "delivered" and orders["moved"].delivery_days == 73
    assert orders["status"].order_status == "canceled"
    assert str(orders["moved"].payment_value) == "99.00"
    lines = {(r.order_id, r.order_item_id) for r in core["fact_order_items"].collect()}
    # "moved" lost its second line; "same" was not in the batch, so its removed line stays.
    assert lines == {("same", 1), ("same", 2), ("moved", 1), ("vanished", 1), ("newest", 1), ("fresh", 1)}
    assert orders["moved"].items_count == 1 and str(orders["moved"].items_value) == "11.00"


def test_load_times_tell_first_and_last_load(spark, loaded):
    orders, _ = facts(spark, loaded[0])
    when = {k: (r.etl_inserted_at.month, r.etl_updated_at.month) for k, r in orders.items()}
    assert when == {"same": (3, 3), "moved": (3, 4), "status": (3, 4), "vanished": (3, 3), "newest": (3, 3), "fresh": (4, 4)}


def test_keys_stay_and_new_ones_follow(spark, loaded):
    root, (first, second) = loaded
    tables = PublishedTables(spark, root)
    before = {r.product_id: r.product_key for r in tables.read(first.version, "core/dim_product").collect()}
    after = {r.product_id: r.product_key for r in tables.read(second.version, "core/dim_product").collect()}
    assert before == {"p1": 1, "p2": 2, "p3": 3} and after == {**before, "p9": 4}
    people = tables.read(second.version, "core/dim_customer").collect()
    assert "person-vanished" in {r.customer_unique_id for r in people}
    assert sorted(r.customer_key for r in people) == list(range(1, 7))


def test_only_touched_months_are_rewritten(loaded):
    _, (first, second) = loaded
    folders = second.version.folders["core/fact_orders"]
    assert sorted(f.split("/", 2)[2] for f in folders) == [
        "run=1/month_part=201712", "run=2/month_part=201801", "run=2/month_part=201802", "run=2/month_part=201803",
    ]
    assert len(first.version.folders["core/fact_orders"]) == 3


def test_log_and_watermark(spark, loaded):
    root, _ = loaded
    tables = PublishedTables(spark, root)
    log = tables.read(tables.latest(), "etl/load_log").orderBy("log_id").collect()
    assert [(r.watermark_before and str(r.watermark_before), str(r.watermark_after), r.rows_new, r.rows_changed) for r in log][:2] == [
        (None, "2018-02-20 08:00:00", 5, 0),
        ("2018-02-20 08:00:00", "2018-03-20 00:00:00", 1, 2),
    ]


def test_repeating_a_load_changes_nothing(spark, loaded):
    root, _ = loaded
    before, _ = facts(spark, root)
    again = run_load(spark, root, second_snapshot(spark), run_ts=THIRD)
    assert (again.rows_new, again.rows_changed) == (0, 0)
    assert facts(spark, root)[0] == before
    tables = PublishedTables(spark, root)
    assert str(tables.read(tables.latest(), "etl/watermark").first().last_watermark) == "2018-03-20 00:00:00"


def test_full_refresh_equals_a_single_load(spark, loaded, tmp_path):
    root, _ = loaded
    refreshed = run_load(spark, root, second_snapshot(spark), full_refresh=True, run_ts=THIRD)
    assert (refreshed.rows_new, refreshed.rows_changed) == (0, 5)
    run_load(spark, str(tmp_path), second_snapshot(spark), run_ts=THIRD)
    ignored = {"customer_key", "etl_inserted_at", "etl_updated_at"}

    def contents(where):
        return {k: {c: v for c, v in r.asDict().items() if c not in ignored} for k, r in facts(spark, where)[0].items()}

    merged = contents(root)
    merged.pop("vanished")
    assert merged == contents(str(tmp_path))


@pytest.mark.parametrize(
    "broken, message",
    [
        ({"items": [line("o", 1), line("o", 2, "unknown product")]}, "2 staged but 1 loaded"),
        ({"customers": [customer("other", "ana")]}, "lack their customer"),
        ({"customers": [customer("o", "ana"), customer("o", "bob")]}, "lack their customer"),
        ({"items": [line("o", 1), line("o", 1)]}, "order_item_id repeats"),
        ({"sellers": [*rows.SELLERS, rows.SELLERS[0]]}, "dim_seller: seller_id repeats"),
    ],
)
def test_a_failed_check_publishes_nothing(spark, tmp_path, broken, message):
    with pytest.raises(CheckFailed, match=message):
        run_load(spark, str(tmp_path), rows.sources(spark, [order("o", "2018-01-01 00:00:00")], **broken))
    assert PublishedTables(spark, str(tmp_path)).latest().run_id == 0


def test_a_failed_load_can_be_repeated(spark, tmp_path):
    good = rows.sources(spark, [order("o", "2018-01-01 00:00:00")], items=[line("o", 1)])
    with pytest.raises(CheckFailed):
        bad = rows.sources(spark, [order("o", "2018-01-01 00:00:00")], items=[line("o", 1, "nothing")])
        run_load(spark, str(tmp_path), bad)
    assert run_load(spark, str(tmp_path), good).rows_new == 1


def test_an_order_that_changes_its_month_moves(spark, tmp_path):
    run_load(spark, str(tmp_path), rows.sources(spark, [order("o", "2018-01-01 00:00:00")], items=[line("o", 1)]))
    later = rows.sources(spark, [order("o", "2018-02-01 00:00:00")], items=[line("o", 1)])
    assert run_load(spark, str(tmp_path), later).rows_changed == 1
    core = core_tables(spark, str(tmp_path))
    assert [r.purchase_date_key for r in core["fact_orders"].collect()] == [20180201]
    assert [r.purchase_date_key for r in core["fact_order_items"].collect()] == [20180201]


def test_watermark_row_is_seeded_once(spark):
    seeded = seed_watermark(spark, None, FIRST)
    assert [tuple(r)[:2] for r in seeded.collect()] == [("fact_orders", None)]
    assert seed_watermark(spark, seeded, SECOND).count() == 1
    orders = rows.table(spark, "orders", [])
    reviews = rows.table(spark, "order_reviews", [])
    assert select_batch(orders, reviews, None, seeded.limit(0)).count() == 0


def dimension_folders(spark, root):
    folders = PublishedTables(spark, root).latest().folders
    return {name: folders[f"core/{name}"] for name in ("dim_date", "dim_customer", "dim_product", "dim_seller")}


def test_an_unchanged_load_writes_no_dimension(spark, tmp_path):
    root = str(tmp_path)
    run_load(spark, root, first_snapshot(spark), run_ts=FIRST)
    before = dimension_folders(spark, root)
    run_load(spark, root, first_snapshot(spark), run_ts=SECOND)
    assert dimension_folders(spark, root) == before


def test_new_keys_are_appended_and_changed_attributes_written_anew(spark, tmp_path):
    root = str(tmp_path)
    run_load(spark, root, first_snapshot(spark), run_ts=FIRST)
    before, old = dimension_folders(spark, root), core_tables(spark, root)
    keys = {r.product_id: r.product_key for r in old["dim_product"].collect()}
    run_load(spark, root, second_snapshot(spark), run_ts=SECOND)
    after, core = dimension_folders(spark, root), core_tables(spark, root)
    assert after["dim_product"][:-1] == before["dim_product"] and len(after["dim_product"]) == 2
    found = {r.product_id: r.product_key for r in core["dim_product"].collect()}
    assert found == keys | {"p9": max(keys.values()) + 1}
    heavier = [{**rows.PRODUCTS[0], "product_weight_g": "12345"}, *rows.PRODUCTS[1:]]
    changed = rows.sources(spark, ORDERS, items=LINES, products=heavier)
    run_load(spark, root, changed, run_ts=THIRD)
    core = core_tables(spark, root)
    assert len(dimension_folders(spark, root)["dim_product"]) == 1
    weights = {r.product_id: (r.product_key, r.weight_g) for r in core["dim_product"].collect()}
    assert weights[rows.PRODUCTS[0]["product_id"]] == (found[rows.PRODUCTS[0]["product_id"]], 12345) and set(weights) == set(found)


def test_the_batch_summary_reads_the_batch_once(spark):
    from parcelmart.plans.batch import batch_summary

    batch = spark.createDataFrame([("new", SECOND), ("changed", FIRST)], "change_type string, at timestamp")
    batch = batch.select("change_type", batch["at"].cast("timestamp_ntz").alias("order_updated_at"))
    summary = batch_summary(batch, seed_watermark(spark, None, FIRST))
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") >= 1 and plan.count("count_if") + plan.count("CASE WHEN") < 12
    row = summary.first()
    assert (row.rows_new, row.rows_changed, row.watermark_before) == (1, 1, None) and row.watermark_after is not None
    empty = batch_summary(batch.limit(0), seed_watermark(spark, None, FIRST)).first()
    assert (empty.rows_new, empty.rows_changed, empty.watermark_after) == (0, 0, None)


def test_a_load_after_an_added_column(spark, tmp_path):
    root = str(tmp_path)
    run_load(spark, root, first_snapshot(spark), run_ts=FIRST)
    tables = PublishedTables(spark, root)
    older = tables.draft()
    fact = tables.read(older, "core/fact_orders").drop("etl_inserted_at", "etl_updated_at", "order_updated_at")
    older.folders["core/fact_orders"] = []
    tables.write_parts(older, "core/fact_orders", fact, "month_part", set())
    tables.publish(older)
    run_load(spark, root, second_snapshot(spark), run_ts=SECOND)
    found, core = facts(spark, root)
    assert set(found) == {"same", "moved", "status", "vanished", "newest", "fresh"}
    # Months that the load did not touch keep their folders, which do not hold the columns.
    assert {r.etl_inserted_at.astimezone(UTC) for r in found.values()} == {SECOND}
    assert found["fresh"].order_updated_at is not None
    run_load(spark, root, second_snapshot(spark), run_ts=THIRD)
    again, _ = facts(spark, root)
    assert {r.etl_inserted_at for r in again.values()} == {r.etl_inserted_at for r in found.values()}


def test_defaults_fill_older_folders_only(spark, tmp_path):
    tables = PublishedTables(spark, str(tmp_path))
    first = tables.draft()
    tables.write(first, "t", spark.range(2))
    tables.publish(first)
    second = tables.draft()
    tables.add_column(second, "t", "kind", "string", "'old'")
    tables.append(second, "t", spark.createDataFrame([(7, None), (8, "new")], "id long, kind string"))
    tables.publish(second)
    latest = tables.read(tables.latest(), "t")
    assert sorted(map(tuple, latest.collect())) == [(0, "old"), (1, "old"), (7, None), (8, "new")]
    third = tables.draft()
    tables.add_column(third, "t", "kind", "string", "'other'")  # there already
    assert tables.read(third, "t").where("kind = 'old'").count() == 2


def test_lines_without_an_order_are_left_out_and_lost_ones_refused(spark, tmp_path):
    """Also in a first load, which looks up no batch for its lines."""
    stray = [*LINES, line("nowhere", 1)]
    run_load(spark, str(tmp_path / "stray"), rows.sources(spark, ORDERS, items=stray), run_ts=FIRST)
    lines = core_tables(spark, str(tmp_path / "stray"))["fact_order_items"]
    assert "nowhere" not in {r.order_id for r in lines.collect()} and lines.count() == len(LINES)
    with pytest.raises(CheckFailed, match="lines of the batch: 7 staged but 6 loaded"):
        lost = [*stray, line("same", 3, "no such product")]
        run_load(spark, str(tmp_path / "lost"), rows.sources(spark, ORDERS, items=lost), run_ts=FIRST)


def test_a_first_load_shuffles_lines_by_order_last(spark):
    schema = "order_id string, order_item_id int, product_id string, seller_id string, price int, freight_value int"
    keys = spark.createDataFrame([("a", 7, 20180101)], "order_id string, customer_key int, purchase_date_key int")
    products = spark.createDataFrame([("p", 1)], "product_id string, product_key int")
    sellers = spark.createDataFrame([("s", 2)], "seller_id string, seller_key int")
    lines = spark.createDataFrame([("a", 1, "p", "s", 1, 1), ("a", 2, "lost", "s", 2, 1), ("other", 1, "p", "s", 4, 1)], schema)
    found = facts_plan.order_items(lines, keys.hint("merge"), products.hint("merge"), sellers.hint("merge"))
    assert [(r.order_id, r.order_item_id, r.product_key, r.seller_key) for r in found.collect()] == [("a", 1, 1, 2)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("SortMergeJoin [order_id") < plan.index("SortMergeJoin [seller_id") < plan.index("SortMergeJoin [product_id")


def test_the_second_load_builds_a_dimension_once(spark, tmp_path, monkeypatch):
    built, kept = [], load.written
    monkeypatch.setattr(load, "written", lambda frame, label: built.append(label) or kept(frame, label))
    run_load(spark, str(tmp_path), first_snapshot(spark), run_ts=FIRST)
    assert "dim_customer" not in built
    run_load(spark, str(tmp_path), second_snapshot(spark), run_ts=SECOND)
    assert built.count("dim_customer") == built.count("dim_product") == built.count("dim_seller") == 1


def test_rows_of_other_orders_are_left_out_before_a_shuffle(spark, tmp_path):
    """The orders of a later batch make a filter for the lines, also where they are too many to be broadcast."""
    spark.range(1000).selectExpr("CAST(id AS STRING) AS order_id", "id AS price").write.parquet(str(tmp_path / "lines"))
    spark.range(20).selectExpr("CAST(50 * id AS STRING) AS order_id", "'new' AS change_type").write.parquet(str(tmp_path / "batch"))
    lines, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("lines", "batch"))
    with load.settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", **load.BATCH_FILTER):
        found = load.in_batch(lines, batch)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
        assert sorted(r.price for r in found.collect()) == [50 * i for i in range(20)]
