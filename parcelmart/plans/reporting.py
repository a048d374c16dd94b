"""Key figures over the star schema. Money stays decimal; averages are rounded on exact quotients.

Dimensions carry no broadcast hint: Spark broadcasts them while they are under its size threshold and falls back
to a shuffle join, with skew handling, beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.numbers import percent, rounded_average, rounded_ratio

# Statuses that are not sales.
NOT_SOLD = ("canceled", "unavailable")
DELIVERED = "delivered"


def is_sold() -> Column:
    return ~F.col("order_status").isin(*NOT_SOLD)


def is_delivered() -> Column:
    return (F.col("order_status") == DELIVERED) & F.col("delivered_date_key").isNotNull()


def monthly_sales(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select(F.col("date_key").alias("purchase_date_key"), "year_month", "year", "month")
    return (
        fact_orders.where(is_sold())
        .join(days, "purchase_date_key")
        .groupBy("year_month", "year", "month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_distinct("customer_key").alias("customers"),
            F.sum("items_value").alias("revenue"),
            F.sum("freight_value").alias("freight"),
            rounded_ratio(F.sum("items_value"), F.count(F.lit(1)), 2).alias("avg_order_value"),
        )
    )


def sales_by_category(fact_order_items: DataFrame, fact_orders: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Lines are combined per (order, category) first, so the order count is a plain count afterwards."""
    categories = dim_product.select("product_key", F.col("category_name_en").alias("category"))
    per_order = (
        fact_order_items.join(categories, "product_key")
        .groupBy("order_id", "category")
        .agg(F.count(F.lit(1)).alias("_lines"), F.sum("price").alias("_revenue"))
    )
    sold = fact_orders.where(is_sold()).select("order_id")
    return (
        per_order.join(sold, "order_id", "left_semi")
        .groupBy("category")
        .agg(
            F.sum("_lines").alias("items_sold"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("_revenue").alias("revenue"),
            rounded_ratio(F.sum("_revenue"), F.sum("_lines"), 2).alias("avg_item_price"),
        )
    )


def delivery_by_state(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders are combined per customer before the join, so a customer with very many orders joins as one row."""
    per_customer = (
        fact_orders.where(is_delivered())
        .groupBy("customer_key")
        .agg(
            F.count(F.lit(1)).alias("_orders"),
            F.sum("delivery_days").alias("_days"),
            F.count("delivery_days").alias("_timed"),
            F.count_if("is_delivered_late").alias("_late"),
            F.sum("review_score").alias("_score"),
            F.count("review_score").alias("_reviewed"),
        )
    )
    return (
        per_customer.join(dim_customer.select("customer_key", "state"), "customer_key")
        .groupBy("state")
        .agg(
            F.sum("_orders").alias("delivered_orders"),
            rounded_ratio(F.sum("_days"), F.sum("_timed"), 1).alias("avg_delivery_days"),
            percent(F.sum("_late"), F.sum("_orders"), 1).alias("late_pct"),
            rounded_ratio(F.sum("_score"), F.sum("_reviewed"), 2).alias("avg_review_score"),
        )
    )


def seller_scorecard(fact_order_items: DataFrame, fact_orders: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """The review score of an order counts once per line, as each line is one sale of the seller."""
    per_order = fact_order_items.groupBy("order_id", "seller_key").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("price").alias("_revenue")
    )
    sold = fact_orders.where(is_sold()).select("order_id", "review_score")
    per_seller = (
        per_order.join(sold, "order_id")
        .groupBy("seller_key")
        .agg(
            F.sum("_lines").alias("items_sold"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("_revenue").alias("revenue"),
            rounded_ratio(
                F.sum(F.col("_lines") * F.col("review_score")),
                F.sum(F.when(F.col("review_score").isNotNull(), F.col("_lines")).otherwise(0)),
                2,
            ).alias("avg_review_score"),
        )
    )
    return per_seller.join(dim_seller.select("seller_key", "seller_id", "city", "state"), "seller_key").select(
        "seller_id", "city", "state", "items_sold", "orders", "revenue", "avg_review_score"
    )


def payment_methods(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.where(is_sold())
        .groupBy(F.coalesce("payment_type", F.lit("unknown")).alias("payment_type"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("payment_value").alias("total_paid"),
            rounded_average(F.col("payment_installments"), 1).alias("avg_installments"),
        )
    )


# Presentation order of each report; the second column settles ties.
REPORT_ORDER = {
    "monthly_sales": ["year_month"],
    "sales_by_category": ["-revenue", "category"],
    "delivery_by_state": ["-delivered_orders", "state"],
    "seller_scorecard": ["-revenue", "seller_id"],
    "payment_methods": ["-orders", "payment_type"],
}


def in_report_order(report: DataFrame, name: str) -> DataFrame:
    return report.orderBy(
        *[
            F.col(column[1:]).desc_nulls_first() if column.startswith("-") else F.col(column).asc_nulls_last()
            for column in REPORT_ORDER[name]
        ]
    )
