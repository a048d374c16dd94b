"""Which orders does a run have to process? A batch high-watermark over the last event of each order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIPELINE = "fact_orders"

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("last_watermark", T.TimestampNTZType(), True),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)


def seed_watermark(spark: SparkSession, existing: DataFrame | None, run_ts: datetime) -> DataFrame:
    """The control row, added when it is absent. A null watermark stands for minus infinity."""
    seed = spark.createDataFrame([(PIPELINE, None, run_ts)], WATERMARK_SCHEMA)
    if existing is None:
        return seed
    return existing.unionByName(seed.join(existing, "pipeline_name", "left_anti").select(*existing.columns))


def orders_with_updates(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders with ``order_updated_at``, the last of five events; missing events are skipped."""
    last_review = reviews.groupBy("order_id").agg(F.max("review_answer_timestamp").alias("_reviewed_at"))
    return orders.join(last_review, "order_id", "left").select(
        *orders.columns,
        F.greatest(
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "_reviewed_at",
        ).alias("order_updated_at"),
    )


def select_batch(
    orders: DataFrame,
    reviews: DataFrame,
    loaded: DataFrame | None,
    watermark: DataFrame,
    full_refresh: bool = False,
) -> DataFrame:
    """New orders, orders with an event after the watermark, and orders whose status differs.

    ``loaded`` holds the orders already in the fact. The result has the source columns, ``order_updated_at``,
    ``change_type`` and ``loaded_date_key``, the purchase day the fact knows the order by.
    Without a watermark row for the load nothing is selected.
    """
    control = watermark.where(F.col("pipeline_name") == PIPELINE).select("last_watermark")
    source = orders_with_updates(orders, reviews).where(control.exists())
    if loaded is None:
        return source.select(
            *orders.columns,
            "order_updated_at",
            F.lit("new").alias("change_type"),
            F.lit(None).cast("int").alias("loaded_date_key"),
        )
    known = loaded.select(
        "order_id",
        F.col("order_status").alias("_loaded_status"),
        F.col("purchase_date_key").alias("loaded_date_key"),
        F.lit(True).alias("_known"),
    )
    unknown = F.col("_known").isNull()
    limit = F.lit(None).cast("timestamp_ntz") if full_refresh else control.scalar()
    newer = F.col("order_updated_at").isNotNull() & (limit.isNull() | (F.col("order_updated_at") > limit))
    status_changed = F.col("_loaded_status") != F.col("order_status")
    return (
        source.join(known, "order_id", "left")
        .where(unknown | newer | status_changed)
        .select(
            *orders.columns,
            "order_updated_at",
            F.when(unknown, "new").otherwise("changed").alias("change_type"),
            "loaded_date_key",
        )
    )


def batch_summary(batch: DataFrame, watermark: DataFrame) -> DataFrame:
    """One row, also for an empty batch: counts per change type and the watermark before and after.

    The watermark never moves back.
    """
    counts = [F.count_if(F.col("change_type") == kind).alias(kind) for kind in ("new", "changed")]
    found = batch.agg(F.struct(F.max("order_updated_at").alias("newest"), *counts)).scalar()
    control = watermark.where(F.col("pipeline_name") == PIPELINE).withColumn("_batch", found)
    return control.select(
        "pipeline_name",
        F.col("last_watermark").alias("watermark_before"),
        F.greatest("last_watermark", "_batch.newest").alias("watermark_after"),
        F.col("_batch.new").alias("rows_new"),
        F.col("_batch.changed").alias("rows_changed"),
    )


def moved_watermark(watermark: DataFrame, summary: DataFrame, run_ts: datetime) -> DataFrame:
    moved = summary.select("pipeline_name", "watermark_after")
    return watermark.join(moved, "pipeline_name", "left").select(
        "pipeline_name",
        F.greatest("last_watermark", "watermark_after").alias("last_watermark"),
        F.when(F.col("pipeline_name") == PIPELINE, F.lit(run_ts)).otherwise(F.col("updated_at")).alias("updated_at"),
    )
