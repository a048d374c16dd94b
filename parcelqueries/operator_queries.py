"""Operators of the staging, dimension, fact and check layers, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelqueries import mapping
from parcelqueries.registry import pick, query
from parcelqueries.sql_tables import capitalised, day_key, whole
from parcelqueries.star import Star
from parcelmart.functions.dates import date_key, days_between
from parcelmart.functions.numbers import guarded_fraction, rounded_average
from parcelmart.functions.text import capitalise_words, place_name, state_code
from parcelmart.operators import checks
from parcelmart.operators.ordering import with_row_number
from parcelmart.plans import batch, dimensions, facts, features, reporting
from parcelmart.sources.staging import as_text, typed

# ---- text to typed columns


@query(
    "e1_timestamps_from_text",
    """SELECT order_id, order_status, CAST(purchased_at AS VARCHAR) AS order_purchase_timestamp,
              CAST(approved_at AS VARCHAR) AS order_approved_at, CAST(carrier_at AS VARCHAR) AS order_delivered_carrier_date,
              CAST(delivered_at AS VARCHAR) AS order_delivered_customer_date,
              CAST(estimated_at AS VARCHAR) AS order_estimated_delivery_date FROM st_orders""",
)
def timestamps_from_text(spark, folder):
    orders = mapping.source(mapping.Given(spark, folder), "orders")
    return typed("orders", as_text("orders", orders)).drop("customer_id")


@query(
    "e3_rounded_ints_from_text",
    f"""SELECT product_id, {whole('description_length')} AS description_length, {whole('weight_g')} AS weight_g
        FROM st_products""",
)
def rounded_ints(spark, folder):
    products = mapping.staged(mapping.Given(spark, folder), "products")
    return products.select(
        "product_id",
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_weight_g").alias("weight_g"),
    )


@query("e4_money_from_text", pick("st_items", "order_id order_item_id $price $freight_value"))
def money_from_text(spark, folder):
    items = mapping.source(mapping.Given(spark, folder), "order_items")
    return typed("order_items", as_text("order_items", items)).select(
        "order_id", "order_item_id", "price", "freight_value"
    )


@query(
    "e6_blank_text_is_null",
    """SELECT count(*) AS products, count(NULLIF(category, '')) AS with_category,
              count(NULLIF(weight_g, '')) AS with_weight FROM st_products""",
)
def blank_is_null(spark, folder):
    products = mapping.staged(mapping.Given(spark, folder), "products")
    category = F.nullif(F.col("product_category_name"), F.lit(""))
    return products.agg(
        F.count(F.lit(1)).alias("products"),
        F.count(category).alias("with_category"),
        F.count("product_weight_g").alias("with_weight"),
    )


@query("e8_last_event", pick("updated_orders", "order_id @order_updated_at"))
def last_event(spark, folder):
    star = Star(spark, folder)
    updated = batch.orders_with_updates(star.staged("orders"), star.staged("order_reviews"))
    return updated.select("order_id", "order_updated_at")


@query(
    "e9_date_keys",
    f"""SELECT order_id, {day_key('purchased_at')} AS purchase_date_key, {day_key('delivered_at')} AS delivered_date_key,
               {day_key('estimated_at')} AS estimated_delivery_date_key FROM st_orders""",
)
def date_keys(spark, folder):
    return Star(spark, folder).staged("orders").select(
        "order_id",
        date_key(F.col("order_purchase_timestamp")).alias("purchase_date_key"),
        date_key(F.col("order_delivered_customer_date")).alias("delivered_date_key"),
        date_key(F.col("order_estimated_delivery_date")).alias("estimated_delivery_date_key"),
    )


@query(
    "e13_days_between",
    """SELECT order_id, CAST(CAST(delivered_at AS DATE) - CAST(purchased_at AS DATE) AS INTEGER) AS delivery_days,
              CAST(CAST(delivered_at AS DATE) - CAST(estimated_at AS DATE) AS INTEGER) AS delivery_delay_days
       FROM st_orders""",
)
def days(spark, folder):
    delivered = F.col("order_delivered_customer_date")
    return Star(spark, folder).staged("orders").select(
        "order_id",
        days_between(delivered, F.col("order_purchase_timestamp")).alias("delivery_days"),
        days_between(delivered, F.col("order_estimated_delivery_date")).alias("delivery_delay_days"),
    )


@query(
    "e14_clean_places",
    f"""SELECT customer_id, {capitalised('trim(city)')} AS city, upper(trim(state)) AS state FROM st_customers""",
)
def clean_places(spark, folder):
    return Star(spark, folder).staged("customers").select(
        "customer_id",
        place_name(F.col("customer_city")).alias("city"),
        state_code(F.col("customer_state")).alias("state"),
    )


@query(
    "e15_capitalised_words",
    f"""SELECT p_partkey, {capitalised("p_name || '-' || upper(p_type) || '''' || p_brand || ' éa' || p_size")} AS title
        FROM part""",
)
def capitalised_words(spark, folder):
    text = F.concat_ws(
        "", "p_name", F.lit("-"), F.upper("p_type"), F.lit("'"), "p_brand", F.lit(" éa"), F.col("p_size").cast("string")
    )
    return mapping.Given(spark, folder)("part").select("p_partkey", capitalise_words(text).alias("title"))


@query(
    "e15_capitalised_documents",
    f"SELECT doc_id, md5({capitalised('text')}) AS title_digest FROM documents",
)
def capitalised_documents(spark, folder):
    return mapping.Given(spark, folder)("documents").select(
        "doc_id", F.md5(capitalise_words(F.col("text"))).alias("title_digest")
    )


@query(
    "e17_freight_share",
    """SELECT order_id, CASE WHEN items_value > 0 THEN CAST(freight_value AS DOUBLE) / CAST(items_value AS DOUBLE) END
       AS freight_share FROM f_orders""",
)
def freight_share(spark, folder):
    orders = Star(spark, folder).fact_orders("order_id", "items_value", "freight_value")
    return orders.select(
        "order_id", guarded_fraction(F.col("freight_value"), F.col("items_value")).alias("freight_share")
    )


@query(
    "e18_rounded_averages",
    """SELECT seller_id, CAST(round(avg(price), 0) AS DOUBLE) AS avg_price_0, CAST(round(avg(price), 1) AS DOUBLE)
       AS avg_price_1, CAST(round(avg(price), 2) AS DOUBLE) AS avg_price_2, CAST(round(avg(price), 4) AS DOUBLE)
       AS avg_price_4 FROM st_items GROUP BY seller_id""",
)
def rounded_averages(spark, folder):
    lines = Star(spark, folder).staged("order_items")
    return lines.groupBy("seller_id").agg(
        *[rounded_average(F.col("price"), digits).alias(f"avg_price_{digits}") for digits in (0, 1, 2, 4)]
    )


@query(
    "e20_late_or_unknown",
    """SELECT is_delivered_late, count(*) AS orders FROM (SELECT CAST(delivered_at AS DATE) > CAST(estimated_at AS DATE)
       AS is_delivered_late FROM st_orders) GROUP BY is_delivered_late""",
)
def late_or_unknown(spark, folder):
    orders = Star(spark, folder).staged("orders")
    late = F.col("order_delivered_customer_date").cast("date") > F.col("order_estimated_delivery_date").cast("date")
    return orders.groupBy(late.alias("is_delivered_late")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "e22_numbers_or_null",
    "SELECT product_id, TRY_CAST(weight_g AS DOUBLE) AS weight, TRY_CAST(category AS DOUBLE) AS category FROM st_products",
)
def numbers_or_null(spark, folder):
    products = mapping.source(mapping.Given(spark, folder), "products")
    return products.select(
        "product_id",
        F.col("product_weight_g").try_cast("double").alias("weight"),
        F.col("product_category_name").try_cast("double").alias("category"),
    )


# ---- filters


def _orders_by(spark, folder, condition):
    orders = Star(spark, folder).fact_orders("order_id", "order_status", "delivered_date_key")
    return orders.where(condition).select("order_id", "order_status")


query(
    "f1_sold_orders",
    "SELECT order_id, order_status FROM st_orders WHERE order_status NOT IN ('canceled', 'unavailable')",
)(lambda spark, folder: _orders_by(spark, folder, reporting.is_sold()))
query(
    "f2_delivered_orders",
    "SELECT order_id, order_status FROM st_orders WHERE order_status = 'delivered' AND delivered_at IS NOT NULL",
)(lambda spark, folder: _orders_by(spark, folder, reporting.is_delivered()))


@query(
    "f4_labelled_or_open",
    """SELECT order_id, order_status FROM st_orders WHERE (order_status = 'delivered' AND delivered_at IS NOT NULL)
       OR (delivered_at IS NULL AND order_status NOT IN ('delivered', 'canceled', 'unavailable'))""",
)
def labelled_or_open(spark, folder):
    return _orders_by(spark, folder, features.is_labelled_or_open())


@query(
    "f3_month_range",
    """SELECT count(*) AS orders, min(purchased_at)::DATE::VARCHAR AS first_day, max(purchased_at)::DATE::VARCHAR AS last_day
       FROM st_orders WHERE strftime(purchased_at, '%Y-%m') BETWEEN '1999-01' AND '2000-08'""",
)
def month_range(spark, folder):
    purchased = F.col("order_purchase_timestamp")
    orders = Star(spark, folder).staged("orders")
    months = F.date_format(purchased, "yyyy-MM").between(mapping.FIRST_MONTH, mapping.LAST_MONTH)
    return orders.where(months).agg(
        F.count(F.lit(1)).alias("orders"),
        F.min(purchased).cast("date").alias("first_day"),
        F.max(purchased).cast("date").alias("last_day"),
    )


# ---- joins of the fact builds


@query(
    "j5_order_lines",
    pick("f_items", "order_id order_item_id customer_unique_id product_id seller_id purchase_date_key $price $freight_value"),
)
def order_lines(spark, folder):
    built = Star(spark, folder).fact_order_items()
    return built.withColumnsRenamed(
        {"customer_key": "customer_unique_id", "product_key": "product_id", "seller_key": "seller_id"}
    )


FACT_COLUMNS = (
    "order_id customer_unique_id purchase_date_key delivered_date_key estimated_delivery_date_key order_status "
    "payment_type payment_installments review_score items_count $items_value $freight_value $payment_value "
    "delivery_days delivery_delay_days is_delivered_late"
)


@query("j7_order_facts", pick("f_orders", FACT_COLUMNS))
def order_facts(spark, folder):
    return Star(spark, folder).fact_orders().withColumnRenamed("customer_key", "customer_unique_id")


@query(
    "j6_batch_payments",
    """SELECT p.order_id, p.payment_sequential, p.payment_type, CAST(p.payment_value AS DOUBLE) AS payment_value
       FROM st_payments p SEMI JOIN b_batch b ON b.order_id = p.order_id""",
)
def batch_payments(spark, folder):
    payments = Star(spark, folder).staged("order_payments")
    return payments.join(second_batch(spark, folder).select("order_id"), "order_id", "left_semi").select(
        "order_id", "payment_sequential", "payment_type", "payment_value"
    )


@query(
    "j8_removed_lines",
    """SELECT f.order_id, f.order_item_id FROM st_items f WHERE NOT EXISTS (SELECT 1 FROM st_items s
       WHERE s.order_id = f.order_id AND s.order_item_id = f.order_item_id AND s.price >= 20000)""",
)
def removed_lines(spark, folder):
    """Known lines that a source without the cheaper ones no longer has."""
    lines = Star(spark, folder).staged("order_items").select("order_id", "order_item_id", "price")
    remaining = lines.where(F.col("price") >= 20000)
    return lines.join(remaining, ["order_id", "order_item_id"], "left_anti").select("order_id", "order_item_id")


@query("j9_orders_without_lines", "SELECT o.order_id FROM st_orders o ANTI JOIN st_items i ON i.order_id = o.order_id")
def orders_without_lines(spark, folder):
    star = Star(spark, folder)
    lines = star.staged("order_items").select("order_id")
    return star.staged("orders").select("order_id").join(lines, "order_id", "left_anti")


# ---- aggregates per order


@query(
    "a2_last_review",
    "SELECT order_id, CAST(max(answered_at) AS VARCHAR) AS reviewed_at FROM st_reviews GROUP BY order_id",
)
def last_review(spark, folder):
    reviews = Star(spark, folder).staged("order_reviews")
    return reviews.groupBy("order_id").agg(F.max("review_answer_timestamp").alias("reviewed_at"))


@query("a3_items_per_order", pick("items_per_order", "order_id items_count $items_value $freight_value"))
def items_per_order(spark, folder):
    return facts.items_per_order(Star(spark, folder).order_lines())


@query("a4_payments_per_order", pick("payments_per_order", "order_id $payment_value payment_installments payment_type"))
def payments_per_order(spark, folder):
    return facts.payments_per_order(Star(spark, folder).staged("order_payments"))


@query(
    "a6_distinct_per_order",
    """SELECT i.order_id, count(DISTINCT i.seller_id) AS n_sellers, count(DISTINCT i.product_id) AS n_products,
              CAST(sum(p.weight_g) AS DOUBLE) AS total_weight_g,
              CAST(sum(CAST(p.length_cm AS BIGINT) * p.height_cm * p.width_cm) AS DOUBLE) AS total_volume_cm3
       FROM st_items i JOIN dim_product p ON p.product_id = i.product_id GROUP BY i.order_id""",
)
def distinct_per_order(spark, folder):
    star = Star(spark, folder)
    return features.item_statistics(star.order_lines(), star.dim_product())


@query("o2_review_per_order", pick("review_per_order", "order_id review_score"))
def review_per_order(spark, folder):
    return facts.review_per_order(Star(spark, folder).staged("order_reviews"))


@query("o3_main_item", pick("line_summary", "order_id main_category seller_state"))
def main_item(spark, folder):
    star = Star(spark, folder)
    return features.main_item(star.order_lines(), star.dim_product(), star.dim_seller())


# ---- dimensions


@query(
    "a1_date_bounds",
    """SELECT CAST(CAST(min(purchased_at) AS DATE) AS VARCHAR) AS first_day,
              CAST(CAST(greatest(max(estimated_at), max(delivered_at)) AS DATE) AS VARCHAR) AS last_day FROM st_orders""",
)
def date_bounds(spark, folder):
    return dimensions.date_bounds(Star(spark, folder).staged("orders"))


@query(
    "d1_dim_date",
    pick("dim_date", "date_key @full_date year quarter month month_name year_month day_of_month day_of_week day_name is_weekend"),
)
def dim_date(spark, folder):
    return Star(spark, folder).dim_date()


@query("d2_dim_customer", pick("dim_customer", "customer_unique_id zip_code_prefix city state"))
def dim_customer(spark, folder):
    return Star(spark, folder).dim_customer().drop("customer_key")


@query(
    "d3_dim_product",
    pick(
        "dim_product",
        "product_id category_name_pt category_name_en name_length description_length photos_qty weight_g length_cm "
        "height_cm width_cm",
    ),
)
def dim_product(spark, folder):
    return Star(spark, folder).dim_product().drop("product_key")


@query("d4_dim_seller", pick("dim_seller", "seller_id zip_code_prefix city state"))
def dim_seller(spark, folder):
    return Star(spark, folder).dim_seller().drop("seller_key")


@query(
    "m8_dense_keys",
    "SELECT product_id, row_number() OVER (ORDER BY product_id) AS product_key FROM st_products",
)
def dense_keys(spark, folder):
    products = Star(spark, folder).staged("products").select("product_id")
    return with_row_number(products, F.col("product_id"), name="product_key").select("product_id", "product_key")


# ---- selecting the batch


def second_batch(spark, folder, full_refresh=False):
    """What a load of the whole source has to process after a load of the earlier snapshot."""
    earlier = {t: typed(t, frame) for t, frame in mapping.earlier_sources(spark, folder).items()
               if t in ("orders", "order_reviews")}
    seen = batch.orders_with_updates(earlier["orders"], earlier["order_reviews"])
    watermark = seen.agg(F.max("order_updated_at").alias("last_watermark")).select(
        F.lit(batch.PIPELINE).alias("pipeline_name"), "last_watermark"
    )
    loaded = earlier["orders"].select(
        "order_id", "order_status", date_key(F.col("order_purchase_timestamp")).alias("purchase_date_key")
    )
    star = Star(spark, folder)
    return batch.select_batch(star.staged("orders"), star.staged("order_reviews"), loaded, watermark, full_refresh)


@query("m1_select_batch", pick("b_batch", "order_id @order_updated_at change_type"))
def select_batch(spark, folder):
    return second_batch(spark, folder).select("order_id", "order_updated_at", "change_type")


@query(
    "m2_full_refresh_batch",
    """SELECT o.order_id, CAST(o.order_updated_at AS VARCHAR) AS order_updated_at,
              CASE WHEN a.order_id IS NULL THEN 'new' ELSE 'changed' END AS change_type
       FROM updated_orders o LEFT JOIN a_orders a ON a.order_id = o.order_id""",
)
def full_refresh_batch(spark, folder):
    return second_batch(spark, folder, full_refresh=True).select("order_id", "order_updated_at", "change_type")


@query(
    "m6_batch_summary",
    """SELECT 'fact_orders' AS pipeline_name,
              (SELECT CAST(max(order_updated_at) AS VARCHAR) FROM a_updated) AS watermark_before,
              CAST(max(order_updated_at) AS VARCHAR) AS watermark_after,
              count(*) FILTER (WHERE change_type = 'new') AS rows_new,
              count(*) FILTER (WHERE change_type = 'changed') AS rows_changed FROM b_batch""",
)
def batch_summary(spark, folder):
    earlier = mapping.earlier_sources(spark, folder)
    seen = batch.orders_with_updates(
        typed("orders", earlier["orders"]), typed("order_reviews", earlier["order_reviews"])
    )
    watermark = seen.agg(F.max("order_updated_at").alias("last_watermark")).select(
        F.lit(batch.PIPELINE).alias("pipeline_name"), "last_watermark"
    )
    return batch.batch_summary(second_batch(spark, folder), watermark)


@query(
    "j10_summary_of_empty_batch",
    """SELECT 'fact_orders' AS pipeline_name, CAST(max(order_updated_at) AS VARCHAR) AS watermark_before,
              CAST(max(order_updated_at) AS VARCHAR) AS watermark_after, CAST(0 AS BIGINT) AS rows_new,
              CAST(0 AS BIGINT) AS rows_changed
       FROM updated_orders""",
)
def summary_of_empty_batch(spark, folder):
    """A load of the same source again: nothing to do, and the watermark stays."""
    star = Star(spark, folder)
    orders, reviews = star.staged("orders"), star.staged("order_reviews")
    seen = batch.orders_with_updates(orders, reviews)
    watermark = seen.agg(F.max("order_updated_at").alias("last_watermark")).select(
        F.lit(batch.PIPELINE).alias("pipeline_name"), "last_watermark"
    )
    loaded = orders.select(
        "order_id", "order_status", date_key(F.col("order_purchase_timestamp")).alias("purchase_date_key")
    )
    return batch.batch_summary(batch.select_batch(orders, reviews, loaded, watermark), watermark)


# ---- checks


@query(
    "c1_lines_staged_and_loaded",
    "SELECT (SELECT count(*) FROM st_items) AS staged, (SELECT count(*) FROM f_items) AS loaded",
)
def lines_staged_and_loaded(spark, folder):
    star = Star(spark, folder)
    staged = star.staged("order_items").agg(F.count(F.lit(1))).scalar()
    return star.fact_order_items().agg(F.count(F.lit(1)).alias("loaded")).select(staged.alias("staged"), "loaded")


@query(
    "c3_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def duplicate_keys(spark, folder):
    return checks.duplicate_keys(mapping.Given(spark, folder)("lineitem"), "l_orderkey", "l_linenumber")


@query(
    "c4_orphan_keys",
    "SELECT DISTINCT o_orderkey AS missing_key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def orphan_keys(spark, folder):
    given = mapping.Given(spark, folder)
    return checks.orphan_keys(given("orders"), "o_orderkey", given("lineitem"), "l_orderkey")


@query(
    "c5_null_counts",
    """SELECT count(*) FILTER (WHERE delivered_date_key IS NULL) AS delivered_date_key,
              count(*) FILTER (WHERE payment_type IS NULL) AS payment_type,
              count(*) FILTER (WHERE review_score IS NULL) AS review_score,
              count(*) FILTER (WHERE order_status IS NULL) AS order_status FROM f_orders""",
)
def null_counts(spark, folder):
    columns = ["delivered_date_key", "payment_type", "review_score", "order_status"]
    return checks.null_counts(Star(spark, folder).fact_orders(*columns), *columns)


@query(
    "c6_outside_domain",
    """SELECT order_status AS value, count(*) AS rows FROM st_orders WHERE order_status NOT IN ('delivered', 'shipped')
       GROUP BY order_status""",
)
def outside_domain(spark, folder):
    return checks.outside_domain(Star(spark, folder).staged("orders"), "order_status", ["delivered", "shipped"])
