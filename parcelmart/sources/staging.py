"""Raw order files: their columns, how to read them as text, and how text becomes typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.functions.numbers import rounded_int
from parcelmart.functions.text import blank_to_null
from parcelmart.sources.files import exists

# Source columns in file order, with the type each one gets after staging.
# "whole" is a number that may carry decimals and is rounded to an int. "amount" keeps 6 decimals until it is
# summed. The misspelt "lenght" is how the source files spell it.
COLUMNS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "string",
        "seller_city": "string",
        "seller_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "whole",
        "product_description_lenght": "whole",
        "product_photos_qty": "whole",
        "product_weight_g": "whole",
        "product_length_cm": "whole",
        "product_height_cm": "whole",
        "product_width_cm": "whole",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": "decimal(10,2)",
        "freight_value": "decimal(10,2)",
    },
    "order_payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "amount",
    },
    "order_reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "int",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz",
    },
}

# Free text lives only here: quoted fields may hold line breaks, which make a file unsplittable.
MULTI_LINE_TABLES = frozenset({"order_reviews"})


def text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS[table]])


def require_files(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail before any load when one of the inputs is absent."""
    missing = [path for path in paths.values() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"missing input files: {missing}")


def read_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """One raw file (or folder of files) as an all-text table; a malformed row stops the job."""
    return (
        spark.read.schema(text_schema(table))
        .options(header=True, quote='"', escape='"', mode="FAILFAST", encoding="UTF-8", enforceSchema=False)
        .option("multiLine", table in MULTI_LINE_TABLES)
        .csv(path)
    )


def _typed_column(name: str, kind: str, is_text: bool) -> Column:
    column = F.col(name)
    if kind == "string":
        return column.cast("string").alias(name)
    if is_text:
        column = blank_to_null(column)
    if kind == "whole":
        return rounded_int(column).alias(name)
    if kind == "amount":
        return column.cast("decimal(16,6)").alias(name)
    return column.cast(kind).alias(name)


def typed(table: str, frame: DataFrame) -> DataFrame:
    """Text columns to their declared types: empty text is null, anything else malformed is an error."""
    kinds = COLUMNS[table]
    text = {field.name for field in frame.schema.fields if isinstance(field.dataType, T.StringType)}
    return frame.select(*[_typed_column(name, kind, name in text) for name, kind in kinds.items()])


def as_text(table: str, frame: DataFrame) -> DataFrame:
    """The all-text form of a staging table, with empty text for missing values."""
    return frame.select(
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in COLUMNS[table]]
    )
