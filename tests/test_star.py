from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from parcelmart.plans import dimensions, facts, features, reporting
from parcelmart.sources.staging import typed
from tests import rows
from tests.rows import customer, line, order, payment, review


def star(spark, *args, **kwargs):
    staged = {name: typed(name, frame) for name, frame in rows.sources(spark, *args, **kwargs).items()}
    lines = staged["order_items"].withColumnsRenamed({"product_id": "product_key", "seller_id": "seller_key"})
    orders = facts.order_customers(staged["orders"], staged["customers"])
    fact = facts.order_facts(orders, lines, staged["order_payments"], staged["order_reviews"])
    product = dimensions.dim_product(staged["products"], staged["category_translation"])
    return {
        "dim_date": dimensions.dim_date(staged["orders"]),
        "dim_customer": dimensions.dim_customer(staged["customers"], staged["orders"]).withColumn(
            "customer_key", F.col("customer_unique_id")
        ),
        "dim_product": product.withColumn("product_key", F.col("product_id")),
        "dim_seller": dimensions.dim_seller(staged["sellers"]).withColumn("seller_key", F.col("seller_id")),
        "fact_orders": fact,
        "fact_order_items": lines,
    }


def by(frame, key):
    return {row[key]: row for row in frame.collect()}


DAY = "2018-01-10 10:00:00"


def test_product_category_falls_back(spark):
    products = by(star(spark, [order("o1", DAY)])["dim_product"], "product_id")
    names = {k: (r.category_name_pt, r.category_name_en, r.weight_g) for k, r in products.items()}
    assert names == {"p1": ("livros", "books", 3), "p2": ("pecas", "pecas", 2), "p3": ("unknown", "unknown", None)}


def test_customer_takes_the_address_of_the_latest_order(spark):
    people = [
        customer("o1", "ana", city="old town"), customer("o2", "ana", city="new town"), customer("none", "bob", city="x"),
    ]
    built = star(spark, [order("o1", DAY), order("o2", "2018-02-10 10:00:00")], customers=people)
    assert {k: r.city for k, r in by(built["dim_customer"], "customer_unique_id").items()} == {
        "ana": "New Town", "bob": "X",
    }


def test_seller_is_cleaned(spark):
    seller = by(star(spark, [order("o1", DAY)])["dim_seller"], "seller_id")["s1"]
    assert (seller.city, seller.state) == ("D'Oeste", "RJ")


def test_calendar_runs_to_the_later_of_estimate_and_delivery(spark):
    built = star(
        spark, [order("o1", "2018-01-30 23:00:00", delivered="2018-02-03 01:00:00", estimated="2018-02-01 00:00:00")]
    )
    days = built["dim_date"].orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20180130, 20180131, 20180201, 20180202, 20180203]
    last = days[-1]
    assert (last.full_date, last.quarter, last.month_name, last.year_month, last.day_of_week, last.day_name, last.is_weekend) == (
        date(2018, 2, 3), 1, "February", "2018-02", 6, "Saturday", True,
    )


def test_order_without_children_has_zero_items_and_no_payment_or_review(spark):
    row = star(spark, [order("o1", DAY)])["fact_orders"].first()
    assert (row.items_count, row.items_value, row.freight_value) == (0, Decimal("0.00"), Decimal("0.00"))
    assert (row.payment_type, row.payment_installments, row.payment_value, row.review_score) == (None,) * 4


def test_payment_of_several_parts(spark):
    parts = [
        payment("o1", 2, "voucher", "1", "2.50"), payment("o1", 1, "credit_card", "3", "7.555"), payment("o1", 3, "boleto"),
    ]
    row = star(spark, [order("o1", DAY)], payments=parts)["fact_orders"].first()
    assert (row.payment_type, row.payment_installments, row.payment_value) == ("credit_card", 3, Decimal("22.06"))


def test_latest_review_counts_and_undated_ones_come_last(spark):
    given = [review("o1", 1), review("o1", 5, "2018-01-01 00:00:00"), review("o2", 2, review_id="a"), review("o2", 4, review_id="b")]
    scores = by(star(spark, [order("o1", DAY), order("o2", DAY)], reviews=given)["fact_orders"], "order_id")
    assert (scores["o1"].review_score, scores["o2"].review_score) == (5, 4)


def test_late_compares_days_not_hours(spark):
    built = star(
        spark,
        [
            order("same", DAY, delivered="2018-02-01 20:00:00", estimated="2018-02-01 00:00:00"),
            order("next", DAY, delivered="2018-02-02 00:00:00", estimated="2018-02-01 00:00:00"),
            order("open", DAY, status="shipped"),
        ],
    )
    late = {k: (r.is_delivered_late, r.delivery_days, r.delivery_delay_days) for k, r in by(built["fact_orders"], "order_id").items()}
    assert late == {"same": (False, 22, 0), "next": (True, 23, 1), "open": (None, None, None)}


def test_reports_leave_out_canceled_and_undated_orders(spark):
    built = star(
        spark,
        [
            order("o1", DAY, delivered="2018-01-20 00:00:00"), order("o2", DAY),
            order("o3", DAY, status="canceled", delivered="2018-01-20 00:00:00"),
        ],
        items=[line("o1", 1), line("o1", 2, price="20.00"), line("o2", 1), line("o3", 1)],
        payments=[payment("o1", 1)],
        reviews=[review("o1", 4), review("o3", 1)],
    )
    month = reporting.monthly_sales(built["fact_orders"], built["dim_date"]).first()
    assert (month.orders, month.customers, month.revenue, month.avg_order_value) == (2, 2, Decimal("40.00"), Decimal("20.00"))
    category = reporting.sales_by_category(built["fact_order_items"], built["fact_orders"], built["dim_product"]).first()
    assert (category.category, category.items_sold, category.orders, category.avg_item_price) == ("books", 3, 2, Decimal("13.33"))
    state = reporting.delivery_by_state(built["fact_orders"], built["dim_customer"]).first()
    assert (state.state, state.delivered_orders, state.avg_delivery_days, state.late_pct) == ("SP", 1, Decimal("10.0"), Decimal("0.0"))
    seller = reporting.seller_scorecard(built["fact_order_items"], built["fact_orders"], built["dim_seller"]).first()
    assert (seller.items_sold, seller.orders, seller.avg_review_score) == (3, 2, Decimal("4.00"))
    methods = {r.payment_type: (r.orders, r.avg_installments) for r in reporting.payment_methods(built["fact_orders"]).collect()}
    assert methods == {"boleto": (1, Decimal("1.0")), "unknown": (1, None)}


def test_features_take_the_dearest_line_and_drop_orders_without_lines(spark):
    built = star(
        spark,
        [order("o1", DAY, delivered="2018-02-05 00:00:00"), order("empty", DAY, delivered="2018-02-05 00:00:00"),
         order("undated", DAY), order("open", DAY, status="invoiced"), order("gone", DAY, status="unavailable")],
        items=[
            line("o1", 1, "p1", "s1", "5.00"), line("o1", 2, "p2", "s2", "9.00"), line("o1", 3, "p3", "s1", "9.00"),
            line("open", 1, "p1", "s2", "0.00", "1.00"), line("undated", 1), line("gone", 1),
        ],
    )
    table = by(
        features.late_delivery_features(
            built["fact_orders"], built["fact_order_items"], built["dim_date"], built["dim_customer"],
            built["dim_product"], built["dim_seller"],
        ),
        "order_id",
    )
    assert set(table) == {"o1", "open"}
    one, still_open = table["o1"], table["open"]
    assert (one.is_late, one.n_items, one.n_sellers, one.n_products, one.total_weight_g, one.total_volume_cm3) == (1, 3, 2, 3, 5.0, 100.0)
    assert (one.main_category, one.seller_state, one.same_state, one.estimated_days) == ("pecas", "SP", 1, 22)
    assert (still_open.is_late, still_open.freight_ratio, still_open.payment_type) == (None, None, None)


def test_item_features_agree_with_their_parts_and_double_no_line(spark):
    from parcelmart.plans.features import item_statistics, line_features, main_item

    lines = [("a", i, i % 3 + 1, i % 2 + 1, 5 + i % 4) for i in range(9)] + [("b", 1, 1, 2, 7)]
    items = spark.createDataFrame(lines, "order_id string, order_item_id int, product_key long, seller_key long, price int")
    products = spark.createDataFrame([(k, k, 2, 3, k, f"c{k}") for k in (1, 2, 3)],
                                     "product_key long, weight_g int, length_cm int, height_cm int, width_cm int, category_name_en string")
    sellers = spark.createDataFrame([(1, "SP"), (2, "RJ")], "seller_key long, state string")
    whole = line_features(items, products, sellers)
    parts = item_statistics(items, products).join(main_item(items, products, sellers), "order_id")
    assert sorted(map(tuple, whole.select(*parts.columns).collect())) == sorted(map(tuple, parts.collect()))
    assert "Expand" not in whole._jdf.queryExecution().executedPlan().toString()
