"""The four dimensions, from typed staging tables. Surrogate keys are added by the load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.dates import WEEKEND_DAYS, date_key, iso_weekday
from parcelmart.functions.text import blank_to_null, place_name, state_code
from parcelmart.operators.picking import latest_per_key

UNKNOWN = "unknown"


def date_bounds(orders: DataFrame) -> DataFrame:
    """One row: first purchase day, and the later of the last estimated and the last actual delivery."""
    return orders.agg(
        F.min("order_purchase_timestamp").cast("date").alias("first_day"),
        F.greatest(F.max("order_estimated_delivery_date"), F.max("order_delivered_customer_date"))
        .cast("date")
        .alias("last_day"),
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day between the bounds, with its calendar attributes."""
    day = F.col("full_date")
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        iso_weekday(day).isin(*WEEKEND_DAYS).alias("is_weekend"),
    )


def dim_date(orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Days of the source, widened to the days already in the warehouse."""
    bounds = date_bounds(orders)
    if existing is not None:
        known = existing.agg(F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))
        bounds = bounds.unionByName(known).agg(
            F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
        )
    return calendar(bounds)


def dim_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per person, with the address given on the latest order."""
    dated = customers.join(orders.select("customer_id", "order_purchase_timestamp"), "customer_id", "left")
    latest = latest_per_key(
        dated,
        "customer_unique_id",
        ["customer_zip_code_prefix", "customer_city", "customer_state"],
        F.col("order_purchase_timestamp"),
        F.col("customer_id"),
    )
    return latest.select(
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        place_name(F.col("customer_city")).alias("city"),
        state_code(F.col("customer_state")).alias("state"),
    )


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Category in two languages; without a translation the source name serves for both."""
    category = blank_to_null(F.col("product_category_name"))
    return products.join(translation, "product_category_name", "left").select(
        "product_id",
        F.coalesce(category, F.lit(UNKNOWN)).alias("category_name_pt"),
        F.coalesce("product_category_name_english", category, F.lit(UNKNOWN)).alias("category_name_en"),
        F.col("product_name_lenght").alias("name_length"),
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_photos_qty").alias("photos_qty"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        place_name(F.col("seller_city")).alias("city"),
        state_code(F.col("seller_state")).alias("state"),
    )
