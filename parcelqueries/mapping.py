"""The given tables seen as the eight staging tables of an order warehouse."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelmart.sources.staging import typed

# The given orders run from 1995-01 to 2001-08; these are 20 months over two years.
FIRST_MONTH, LAST_MONTH = "1999-01", "2000-08"

# The earlier of two snapshots shows the source as it was before this moment.
SNAPSHOT_TIME = datetime(2001, 3, 1)


class Given:
    """The given tables of one folder; each is opened once, however many staging tables draw on it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._opened: dict[str, DataFrame] = {}

    def __call__(self, table: str) -> DataFrame:
        if table not in self._opened:
            self._opened[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._opened[table]


def _after(moment, days=0, hours=0):
    return moment + F.make_dt_interval(F.lit(days) if isinstance(days, int) else days.cast("int"), F.lit(hours))


def _id(column: str):
    return F.col(column).cast("string")


def orders(given: Given) -> DataFrame:
    key, placed = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    kind = key % 50
    status = (
        F.when(kind == 0, "canceled").when(kind == 1, "unavailable").when(kind < 5, "shipped").otherwise("delivered")
    )
    delivered = F.when((kind >= 5) & (key % 97 != 5), _after(placed, days=3 + (key * 7919) % 38))
    return given("orders").select(
        _id("o_orderkey").alias("order_id"),
        _id("o_orderkey").alias("customer_id"),
        status.alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        F.when(kind != 1, _after(placed, hours=1)).alias("order_approved_at"),
        F.when(kind > 1, _after(placed, days=2)).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        _after(placed, days=15 + (key * 104729) % 25).alias("order_estimated_delivery_date"),
    )


def customers(given: Given) -> DataFrame:
    """One row per order; a person's state changes between orders."""
    nation = given("nation").select("n_nationkey", "n_name")
    people = given("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    placed = given("orders").select("o_orderkey", "o_custkey")
    return (
        placed.join(people, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("_nation", ((F.col("c_nationkey") + F.col("o_orderkey") % 3) % 25).cast("int"))
        .join(nation, F.col("_nation") == F.col("n_nationkey"))
        .select(
            _id("o_orderkey").alias("customer_id"),
            _id("o_custkey").alias("customer_unique_id"),
            (F.col("o_custkey") % 1000).cast("string").alias("customer_zip_code_prefix"),
            F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("customer_city"),
            F.lower("n_name").alias("customer_state"),
        )
    )


def customer_ids(given: Given) -> DataFrame:
    """The person behind each order, without the address; no given order lacks its customer."""
    return given("orders").select(_id("o_orderkey").alias("customer_id"), _id("o_custkey").alias("customer_unique_id"))


def order_items(given: Given) -> DataFrame:
    """Lines are numbered as they are given and cast afterwards, so that the shuffle carries no column twice; it is by the
    order's text id, which what follows joins on. Flags come behind the columns that make up a row: they part equal rows only.
    """
    every_column = Window.partitionBy("order_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    )
    numbered = given("lineitem").select(
        _id("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        "l_quantity", "l_discount", "l_tax",
    )
    numbered = numbered.withColumn("order_item_id", F.row_number().over(every_column))
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    freight = (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)")
    return numbered.select(
        "order_id",
        "order_item_id",
        _id("l_partkey").alias("product_id"),
        _id("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
    )


def order_payments(given: Given) -> DataFrame:
    key, priority = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1)
    method = (
        F.when(priority.isin("1", "2"), "credit_card")
        .when(priority == "3", "boleto")
        .when(priority == "5", "debit_card")
        .otherwise("voucher")
    )

    def payment(sequential, kind, installments, value):
        return F.struct(
            F.lit(sequential).alias("payment_sequential"),
            kind.alias("payment_type"),
            installments.cast("int").alias("payment_installments"),
            value.cast("decimal(12,2)").alias("payment_value"),
        )

    first = payment(1, method, 1 + key % 10, F.col("o_totalprice"))
    second = payment(2, F.lit("voucher"), F.lit(1), F.lit(5))
    paid = F.when(key % 89 == 0, F.array()).when(key % 7 == 0, F.array(first, second)).otherwise(F.array(first))
    return (
        given("orders")
        .select(_id("o_orderkey").alias("order_id"), F.explode(paid).alias("payment"))
        .select("order_id", "payment.*")
    )


def order_reviews(given: Given) -> DataFrame:
    key, placed = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")

    def review(number, score, days, dated):
        return F.struct(
            F.concat(_id("o_orderkey"), F.lit(f"-{number}")).alias("review_id"),
            score.cast("int").alias("review_score"),
            F.when(key % 4 == 0, F.concat(F.lit("no. "), F.lit(number))).alias("review_comment_title"),
            F.concat(F.lit('said "fine", then:\nline '), _id("o_orderkey")).alias("review_comment_message"),
            _after(placed, days=days - 5).alias("review_creation_date"),
            F.when(dated, _after(placed, days=days)).alias("review_answer_timestamp"),
        )

    first = review(1, 1 + (key * 31) % 5, 45, key % 13 != 0)
    second = review(2, 1 + key % 5, 50, F.lit(True))
    written = F.when(key % 31 == 0, F.array()).when(key % 11 == 0, F.array(first, second)).otherwise(F.array(first))
    return (
        given("orders")
        .select(_id("o_orderkey").alias("order_id"), F.explode(written).alias("review"))
        .select("order_id", "review.*")
    )


def products(given: Given) -> DataFrame:
    """Measures as text, as in the files: the weight ends in .5 and is sometimes empty."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return given("part").select(
        _id("p_partkey").alias("product_id"),
        F.when(key % 40 == 0, "").otherwise(F.col("p_brand")).alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        F.concat((F.length("p_type") * 10).cast("string"), F.lit(".4")).alias("product_description_lenght"),
        (1 + size % 5).cast("string").alias("product_photos_qty"),
        F.when(key % 60 == 0, "").otherwise(F.concat((size * 100).cast("string"), F.lit(".5"))).alias("product_weight_g"),
        (10 + size).cast("string").alias("product_length_cm"),
        (5 + size % 7).cast("string").alias("product_height_cm"),
        (8 + size % 11).cast("string").alias("product_width_cm"),
    )


def category_translation(given: Given) -> DataFrame:
    """One brand has no translation."""
    return (
        given("part")
        .select(F.col("p_brand").alias("product_category_name"))
        .where(F.col("product_category_name") != "Brand#1")
        .distinct()
        .withColumn("product_category_name_english", F.concat(F.lit("cat_"), F.lower("product_category_name")))
    )


def sellers(given: Given) -> DataFrame:
    nation = given("nation").select("n_nationkey", "n_name")
    return (
        given("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _id("s_suppkey").alias("seller_id"),
            _id("s_suppkey").alias("seller_zip_code_prefix"),
            F.lower("s_name").alias("seller_city"),
            F.lower("n_name").alias("seller_state"),
        )
    )


BUILDERS = {
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "category_translation": category_translation,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
}


def source(given: Given, table: str) -> DataFrame:
    """One staging table as the source delivers it."""
    return BUILDERS[table](given)


def staged(given: Given, table: str) -> DataFrame:
    """One staging table with typed columns."""
    return typed(table, source(given, table))


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    given = Given(spark, folder)
    return {table: source(given, table) for table in BUILDERS}


def earlier_sources(spark: SparkSession, folder: str, moment: datetime = SNAPSHOT_TIME) -> dict[str, DataFrame]:
    """The source as it stood at ``moment``: later orders and later events are not there yet."""
    tables = sources(spark, folder)
    limit = F.lit(moment).cast("timestamp_ntz")
    events = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]
    seen = tables["orders"].where(F.col("order_purchase_timestamp") < limit)
    undone = (F.col("order_status") == "delivered") & F.coalesce(
        F.col("order_delivered_customer_date") >= limit, F.lit(False)
    )
    tables["orders"] = seen.withColumns(
        {
            "order_status": F.when(undone, "shipped").otherwise(F.col("order_status")),
            **{name: F.when(F.col(name) < limit, F.col(name)) for name in events},
        }
    )
    placed = seen.select("order_id")
    for table in ("order_items", "order_payments", "order_reviews"):
        tables[table] = tables[table].join(placed, "order_id", "left_semi")
    tables["order_reviews"] = tables["order_reviews"].where(
        F.col("review_answer_timestamp").isNull() | (F.col("review_answer_timestamp") < limit)
    )
    tables["customers"] = tables["customers"].join(
        placed.withColumnRenamed("order_id", "customer_id"), "customer_id", "left_semi"
    )
    return tables
