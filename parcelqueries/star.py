"""The star schema derived straight from the given tables, lazily, for queries that publish nothing.

Without a load there are no surrogate keys; each dimension's own id serves as its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelqueries import mapping
from parcelmart.functions.dates import date_key
from parcelmart.plans import dimensions, facts


class Star:
    def __init__(self, spark: SparkSession, folder: str):
        self.given = mapping.Given(spark, folder)

    def staged(self, table: str) -> DataFrame:
        return mapping.staged(self.given, table)

    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.staged("orders"))

    def dim_customer(self) -> DataFrame:
        built = dimensions.dim_customer(self.staged("customers"), self.staged("orders"))
        return built.withColumn("customer_key", F.col("customer_unique_id"))

    def dim_product(self) -> DataFrame:
        built = dimensions.dim_product(self.staged("products"), self.staged("category_translation"))
        return built.withColumn("product_key", F.col("product_id"))

    def dim_seller(self) -> DataFrame:
        return dimensions.dim_seller(self.staged("sellers")).withColumn("seller_key", F.col("seller_id"))

    def order_keys(self) -> DataFrame:
        return facts.order_customers(self.staged("orders"), mapping.customer_ids(self.given)).select(
            "order_id", "customer_key", date_key(F.col("order_purchase_timestamp")).alias("purchase_date_key")
        )

    def order_lines(self) -> DataFrame:
        """Lines with the keys that need no lookup; enough for reports that join the order anyway."""
        return self.staged("order_items").select(
            "order_id",
            "order_item_id",
            F.col("product_id").alias("product_key"),
            F.col("seller_id").alias("seller_key"),
            "price",
            "freight_value",
        )

    def fact_order_items(self) -> DataFrame:
        return facts.order_items(
            self.staged("order_items"), self.order_keys(), self.dim_product(), self.dim_seller()
        )

    def fact_orders(self, *columns: str) -> DataFrame:
        """All columns, or the named ones; the customer lookup is skipped when nobody asks for its key."""
        orders = self.staged("orders")
        if not columns or "customer_key" in columns:
            orders = facts.order_customers(orders, mapping.customer_ids(self.given))
        wanted = set(columns)

        def child(child_columns, build):
            return build() if not wanted or wanted & child_columns else None

        return facts.order_facts(
            orders,
            child(facts.ITEM_COLUMNS, self.order_lines),
            child(facts.PAYMENT_COLUMNS, lambda: self.staged("order_payments")),
            child(facts.REVIEW_COLUMNS, lambda: self.staged("order_reviews")),
            list(columns) or None,
        )
