"""The two facts: one row per order, one row per order line.

Every child table is brought to one row per order before it is joined, so no join multiplies rows. The children,
the orders and the batch all meet on ``order_id``: each is shuffled once and the joins chain without another
exchange. A key that holds a large share of the lines or orders is combined on the map side where it is
aggregated; in the joins adaptive execution splits it, because nothing after them relies on their partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.dates import date_key, days_between
from parcelmart.operators.picking import first_by, latest_per_key

ITEM_COLUMNS = {"items_count", "items_value", "freight_value"}
PAYMENT_COLUMNS = {"payment_type", "payment_installments", "payment_value"}
REVIEW_COLUMNS = {"review_score"}


def order_items(lines: DataFrame, order_keys: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Order lines with the keys of their order, product and seller.

    ``order_keys`` has order_id, customer_key and purchase_date_key, and limits the result to its orders. The order comes
    last: the lines of an order then lie side by side, which keeps what is shuffled and written after it small.
    """
    return (
        lines.join(products.select("product_id", "product_key"), "product_id")
        .join(sellers.select("seller_id", "seller_key"), "seller_id")
        .join(order_keys.select("order_id", "customer_key", "purchase_date_key"), "order_id")
        .select(
            "order_id", "order_item_id", "customer_key", "product_key", "seller_key", "purchase_date_key",
            "price", "freight_value",
        )
    )


def items_per_order(order_lines: DataFrame) -> DataFrame:
    return order_lines.groupBy("order_id").agg(
        F.count(F.lit(1)).cast("int").alias("items_count"),
        F.sum("price").cast("decimal(12,2)").alias("items_value"),
        F.sum("freight_value").cast("decimal(12,2)").alias("freight_value"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").cast("decimal(12,2)").alias("payment_value"),
        F.max("payment_installments").alias("payment_installments"),
        first_by(F.col("payment_type"), F.col("payment_sequential")).alias("payment_type"),
    )


def review_per_order(reviews: DataFrame) -> DataFrame:
    """The most recently answered review."""
    return latest_per_key(
        reviews, "order_id", ["review_score"], F.col("review_answer_timestamp"), F.col("review_id")
    )


def order_customers(orders: DataFrame, customers: DataFrame, dim_customer: DataFrame | None = None) -> DataFrame:
    """Orders with ``customer_key``; without a keyed dimension the person's own id is the key."""
    people = customers.select("customer_id", "customer_unique_id")
    if dim_customer is None:
        people = people.withColumnRenamed("customer_unique_id", "customer_key")
    else:
        people = people.join(dim_customer.select("customer_unique_id", "customer_key"), "customer_unique_id").drop(
            "customer_unique_id"
        )
    return orders.join(people, "customer_id")


def order_facts(
    orders: DataFrame,
    order_lines: DataFrame | None,
    payments: DataFrame | None,
    reviews: DataFrame | None,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per order; ``orders`` carries ``customer_key``, ``order_lines`` has price and freight_value.

    Catalyst cannot see that a child is unique per order, so it keeps a left join nobody reads from. Naming the
    wanted ``columns`` leaves such a child out; it may then be None.
    """
    wanted = None if columns is None else set(columns)

    def needed(child_columns: set[str]) -> bool:
        return wanted is None or bool(wanted & child_columns)

    joined = orders
    if needed(ITEM_COLUMNS):
        joined = joined.join(items_per_order(order_lines), "order_id", "left")
    if needed(PAYMENT_COLUMNS):
        joined = joined.join(payments_per_order(payments), "order_id", "left")
    if needed(REVIEW_COLUMNS):
        joined = joined.join(review_per_order(reviews), "order_id", "left")

    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    no_money = F.lit(0).cast("decimal(12,2)")
    rules = {
        "order_id": F.col("order_id"),
        "customer_key": F.col("customer_key"),
        "purchase_date_key": date_key(purchased),
        "delivered_date_key": date_key(delivered),
        "estimated_delivery_date_key": date_key(estimated),
        "order_status": F.col("order_status"),
        "payment_type": F.col("payment_type"),
        "payment_installments": F.col("payment_installments"),
        "review_score": F.col("review_score"),
        "items_count": F.coalesce("items_count", F.lit(0)),
        "items_value": F.coalesce("items_value", no_money),
        "freight_value": F.coalesce("freight_value", no_money),
        "payment_value": F.col("payment_value"),
        "delivery_days": days_between(delivered, purchased),
        "delivery_delay_days": days_between(delivered, estimated),
        "is_delivered_late": delivered.cast("date") > estimated.cast("date"),
    }
    if "order_updated_at" in orders.columns:
        rules["order_updated_at"] = F.col("order_updated_at")
    return joined.select(*[rule.alias(name) for name, rule in rules.items() if wanted is None or name in wanted])
