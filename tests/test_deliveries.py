import csv
import os

from parcelmart.plans.load import core_tables, run_load
from parcelmart.sources.staging import COLUMNS
from parcelmart.streaming.deliveries import load_deliveries
from tests import rows
from tests.rows import customer, line, order, payment, review


def deliver(folder, stamp, **tables):
    """Write a delivery; tables that are not given have a header only."""
    folder.mkdir(parents=True)
    for name, columns in COLUMNS.items():
        with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.DictWriter(file, list(columns), restval="", quoting=csv.QUOTE_ALL)
            writer.writeheader()
            writer.writerows(tables.get(name, []))
        os.utime(folder / f"{name}.csv", (stamp, stamp))


def test_changes_only_lead_to_the_same_facts_as_a_full_snapshot(spark, tmp_path):
    old = [order("a", "2018-01-05 08:00:00", status="shipped"), order("b", "2018-01-06 08:00:00")]
    moved = order("a", "2018-01-05 08:00:00", delivered="2018-01-20 00:00:00")
    new = order("c", "2018-01-07 08:00:00")
    lines = [line("a", 1), line("b", 1), line("c", 1, "p2", price="3.00")]
    people = [customer(o, f"person-{o}") for o in "abc"]
    landing = tmp_path / "landing"
    deliver(
        landing / "day-1", 1_600_000_000, orders=old, order_items=lines[:2], customers=people[:2],
        products=rows.PRODUCTS, sellers=rows.SELLERS, category_translation=rows.TRANSLATION,
        order_reviews=[review("b", 4)],
    )
    loads = []

    def run():
        load_deliveries(
            spark, str(landing), str(tmp_path / "root"), str(tmp_path / "checkpoint"),
            lambda folder, result: loads.append((folder.rsplit("/", 1)[1], result.rows_new, result.rows_changed)),
        )

    run()
    deliver(
        landing / "day-2", 1_600_100_000, orders=[moved, new], order_items=[lines[0], lines[2]],
        customers=[people[0], people[2]], order_payments=[payment("c", 1)],
    )
    run()
    run()
    assert loads == [("day-1", 2, 0), ("day-2", 1, 1)]

    whole = rows.sources(
        spark, [moved, old[1], new], customers=people, items=lines, payments=[payment("c", 1)], reviews=[review("b", 4)]
    )
    run_load(spark, str(tmp_path / "whole"), whole)

    def contents(root):
        frame = core_tables(spark, str(root))["fact_orders"].drop("customer_key", "etl_inserted_at", "etl_updated_at")
        return sorted(map(tuple, frame.collect()), key=lambda r: r[0])

    assert contents(tmp_path / "root") == contents(tmp_path / "whole")


def test_a_delivery_without_orders_is_loaded(spark, tmp_path):
    landing, loads = tmp_path / "landing", []
    deliver(
        landing / "day-1", 1_600_000_000, orders=[order("a", "2018-01-05 08:00:00")], order_items=[line("a", 1)],
        customers=[customer("a", "person-a")], products=rows.PRODUCTS, sellers=rows.SELLERS, category_translation=rows.TRANSLATION,
    )
    deliver(landing / "day-2", 1_600_100_000, sellers=[{**rows.SELLERS[0], "seller_city": "elsewhere"}])
    load_deliveries(
        spark, str(landing), str(tmp_path / "root"), str(tmp_path / "checkpoint"),
        lambda folder, result: loads.append((folder.rsplit("/", 1)[1], result.rows_new, result.rows_changed)),
    )
    assert loads == [("day-1", 1, 0), ("day-2", 0, 0)]
    cities = {r.seller_id: r.city for r in core_tables(spark, str(tmp_path / "root"))["dim_seller"].collect()}
    assert cities[rows.SELLERS[0]["seller_id"]].lower() == "elsewhere"
