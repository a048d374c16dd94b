"""The warehouse itself: CSV files in, two incremental loads, published tables, and a trained model.

Two loads (an earlier snapshot of the source, then the whole source) and one model run serve all queries of a
session over the same files. They live in the cluster's shared folder until the application ends.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelqueries import mapping
from parcelqueries.operator_queries import FACT_COLUMNS
from parcelqueries.registry import pick, query
from parcelqueries.sql_tables import whole
from parcelmart.operators import checks
from parcelmart.plans import reporting
from parcelmart.plans.late_model import run_late_model
from parcelmart.plans.load import MONTH, core_tables, csv_sources, run_load, stage
from parcelmart.plans.risk_views import open_orders_at_risk, test_risk_deciles
from parcelmart.shared import scratch_path
from parcelmart.sources.files import fingerprint
from parcelmart.sources.published import PublishedTables
from parcelmart.sources.staging import COLUMNS, as_text, typed

# At noon, so that the day is the same in most time zones.
FIRST_RUN, SECOND_RUN = datetime(2001, 3, 1, 12, tzinfo=UTC), datetime(2001, 9, 1, 12, tzinfo=UTC)


_built: dict[tuple, str] = {}


def _once(kind: str, spark: SparkSession, folder: str, build) -> str:
    """The folder ``build`` filled, built again when the session or the given files have changed."""
    key = (kind, spark.sparkContext.applicationId, fingerprint(spark, folder))
    if key not in _built:
        root = scratch_path(spark, kind)
        build(root)
        _built[key] = root
    return _built[key]


def warehouse(spark: SparkSession, folder: str) -> str:
    def build(root: str) -> None:
        run_load(spark, root, mapping.earlier_sources(spark, folder), run_ts=FIRST_RUN)
        run_load(spark, root, mapping.sources(spark, folder), run_ts=SECOND_RUN)

    return _once("warehouse", spark, folder, build)


def modelled(spark: SparkSession, folder: str) -> str:
    root = warehouse(spark, folder)
    _once("model", spark, folder, lambda marker: run_late_model(spark, root))
    return root


def published(spark: SparkSession, folder: str, table: str) -> DataFrame:
    tables = PublishedTables(spark, warehouse(spark, folder))
    return tables.read(tables.latest(), table)


def csv_folder(spark: SparkSession, folder: str, table: str) -> str:
    """One staging table as raw CSV files."""

    def build(root: str) -> None:
        text = as_text(table, mapping.sources(spark, folder)[table])
        options = text.write.options(header=True, quote='"', escape='"', emptyValue="")
        # Blanks around a field are part of it.
        options.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(root)

    return _once(f"csv-{table}", spark, folder, build)


def from_csv(spark: SparkSession, folder: str, tables: Iterable[str] = COLUMNS) -> dict[str, DataFrame]:
    """The named staging tables by way of their files; files that nobody asks for are not written."""
    return csv_sources(spark, {table: csv_folder(spark, folder, table) for table in tables})


@query(
    "s1_csv_reviews",
    """SELECT review_id, order_id, review_score, title AS review_comment_title,
              'said "fine", then:' || chr(10) || 'line ' || order_id AS review_comment_message,
              CAST(answered_at AS VARCHAR) AS review_answer_timestamp FROM st_reviews""",
)
def csv_reviews(spark, folder):
    """Quotes, commas and line breaks inside a field survive the way through a file."""
    return typed("order_reviews", from_csv(spark, folder, ["order_reviews"])["order_reviews"]).drop("review_creation_date")


@query("s1_csv_order_items", pick("st_items", "order_id order_item_id product_id seller_id $price $freight_value"))
def csv_items(spark, folder):
    return typed("order_items", from_csv(spark, folder, ["order_items"])["order_items"]).drop("shipping_limit_date")


_REVIEW = "o_orderdate + to_days(CASE WHEN review_id LIKE '%-1' THEN 40 ELSE 45 END)"

#: Each of the eight files with all its columns.
WHOLE_FILES = {
    "customers": """SELECT customer_id, customer_unique_id, zip AS customer_zip_code_prefix, city AS customer_city,
       state AS customer_state FROM st_customers""",
    "sellers": """SELECT seller_id, zip AS seller_zip_code_prefix, city AS seller_city, state AS seller_state
       FROM st_sellers""",
    "products": f"""SELECT product_id, NULLIF(category, '') AS product_category_name,
       {whole('name_length')} AS product_name_lenght, {whole('description_length')} AS product_description_lenght,
       {whole('photos_qty')} AS product_photos_qty, {whole('weight_g')} AS product_weight_g,
       {whole('length_cm')} AS product_length_cm, {whole('height_cm')} AS product_height_cm,
       {whole('width_cm')} AS product_width_cm FROM st_products""",
    "category_translation": """SELECT category AS product_category_name, english AS product_category_name_english
       FROM st_translation""",
    "orders": """SELECT order_id, customer_id, order_status, CAST(purchased_at AS VARCHAR) AS order_purchase_timestamp,
       CAST(approved_at AS VARCHAR) AS order_approved_at, CAST(carrier_at AS VARCHAR) AS order_delivered_carrier_date,
       CAST(delivered_at AS VARCHAR) AS order_delivered_customer_date,
       CAST(estimated_at AS VARCHAR) AS order_estimated_delivery_date FROM st_orders""",
    "order_items": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
            l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS INTEGER) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
       CAST(l_shipdate AS VARCHAR) AS shipping_limit_date, CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS DOUBLE)
       AS freight_value FROM lineitem""",
    "order_payments": pick(
        "st_payments", "order_id payment_sequential payment_type payment_installments $payment_value"
    ),
    "order_reviews": f"""SELECT review_id, order_id, review_score, title AS review_comment_title,
       'said "fine", then:' || chr(10) || 'line ' || order_id AS review_comment_message,
       CAST({_REVIEW} AS VARCHAR) AS review_creation_date, CAST(answered_at AS VARCHAR) AS review_answer_timestamp
       FROM st_reviews JOIN orders ON CAST(o_orderkey AS VARCHAR) = order_id""",
}
for _table, _sql in WHOLE_FILES.items():
    query(f"s1_csv_whole_{_table}", _sql)(
        lambda spark, folder, table=_table: typed(table, from_csv(spark, folder, [table])[table])
    )


@query(
    "s4_rows_loaded",
    """SELECT 'customers' AS table_name, count(*) AS rows FROM st_customers
       UNION ALL SELECT 'sellers', count(*) FROM st_sellers UNION ALL SELECT 'products', count(*) FROM st_products
       UNION ALL SELECT 'category_translation', count(*) FROM st_translation
       UNION ALL SELECT 'orders', count(*) FROM st_orders UNION ALL SELECT 'order_items', count(*) FROM st_items
       UNION ALL SELECT 'order_payments', count(*) FROM st_payments
       UNION ALL SELECT 'order_reviews', count(*) FROM st_reviews""",
)
def rows_loaded(spark, folder):
    """Rows per file, as observed while the files are staged."""
    tables = PublishedTables(spark, scratch_path(spark, "staging"))
    rows = stage(tables, tables.draft(), from_csv(spark, folder))
    return spark.createDataFrame(list(rows.items()), "table_name string, rows bigint")


@query("s3_replaced_snapshot", pick("st_orders", "order_id order_status"))
def replaced_snapshot(spark, folder):
    """Staging holds the second snapshot only."""
    return published(spark, folder, "staging/orders").select("order_id", "order_status")


def _natural(spark, folder, fact: str) -> DataFrame:
    """A published fact with the dimensions' own ids instead of the surrogate keys."""
    core = core_tables(spark, warehouse(spark, folder))
    frame = core[fact]
    for name, natural in (("customer", "customer_unique_id"), ("product", "product_id"), ("seller", "seller_id")):
        if f"{name}_key" in frame.columns:
            frame = frame.join(core[f"dim_{name}"].select(f"{name}_key", natural), f"{name}_key").drop(f"{name}_key")
    return frame.drop(MONTH)


@query(
    "m3_order_items_after_two_loads",
    pick("f_items", "order_id order_item_id customer_unique_id product_id seller_id purchase_date_key $price $freight_value"),
)
def items_after_two_loads(spark, folder):
    return _natural(spark, folder, "fact_order_items")


@query("j8_lines_lost_between_snapshots", "SELECT order_id, order_item_id FROM f_items WHERE price < 20000")
def lost_lines(spark, folder):
    """Lines of the first of two snapshots that a load of the second, without the cheaper lines, took out of the fact."""

    def build(root: str) -> None:
        first = mapping.sources(spark, folder)
        run_load(spark, root, first, run_ts=FIRST_RUN)
        second = first | {"order_items": first["order_items"].where("price >= 20000")}
        run_load(spark, root, second, full_refresh=True, run_ts=SECOND_RUN)

    left = core_tables(spark, _once("lost-lines", spark, folder, build))["fact_order_items"]
    known = mapping.sources(spark, folder)["order_items"].select("order_id", "order_item_id")
    return known.join(left.select("order_id", "order_item_id"), ["order_id", "order_item_id"], "left_anti")


@query(
    "m5_orders_after_two_loads",
    f"""{pick('f_orders', FACT_COLUMNS + ' @order_updated_at').replace(' FROM f_orders', '')},
        CASE WHEN order_id IN (SELECT order_id FROM a_orders) THEN '2001-03-01' ELSE '2001-09-01' END AS first_loaded,
        CASE WHEN order_id IN (SELECT order_id FROM b_batch) THEN '2001-09-01' ELSE '2001-03-01' END AS last_loaded
        FROM f_orders""",
)
def orders_after_two_loads(spark, folder):
    """Changed orders keep the time of their first load."""
    orders = _natural(spark, folder, "fact_orders")
    return orders.select(
        "*",
        F.date_format("etl_inserted_at", "yyyy-MM-dd").alias("first_loaded"),
        F.date_format("etl_updated_at", "yyyy-MM-dd").alias("last_loaded"),
    ).drop("etl_inserted_at", "etl_updated_at")


@query(
    "m6_load_log",
    """SELECT 'fact_orders' AS pipeline_name, CAST(NULL AS VARCHAR) AS watermark_before,
              CAST(max(order_updated_at) AS VARCHAR) AS watermark_after, count(*) AS rows_new, 0 AS rows_changed,
              '2001-03-01' AS run_day, false AS full_refresh FROM a_updated
       UNION ALL
       SELECT 'fact_orders', (SELECT CAST(max(order_updated_at) AS VARCHAR) FROM a_updated),
              CAST(max(order_updated_at) AS VARCHAR), count(*) FILTER (WHERE change_type = 'new'),
              count(*) FILTER (WHERE change_type = 'changed'), '2001-09-01', false FROM b_batch""",
)
def load_log(spark, folder):
    return published(spark, folder, "etl/load_log").select(
        "pipeline_name", "watermark_before", "watermark_after", "rows_new", "rows_changed",
        F.date_format("run_at", "yyyy-MM-dd").alias("run_day"), "full_refresh",
    )


@query(
    "m7_watermark",
    "SELECT 'fact_orders' AS pipeline_name, CAST(max(order_updated_at) AS VARCHAR) AS last_watermark FROM updated_orders",
)
def watermark(spark, folder):
    return published(spark, folder, "etl/watermark").select("pipeline_name", "last_watermark")


@query(
    "m8_customer_keys",
    """SELECT count(*) AS customers, count(*) AS keys, CAST(1 AS BIGINT) AS lowest, count(*) AS highest FROM dim_customer""",
)
def customer_keys(spark, folder):
    """After two loads the keys are still unique and without gaps."""
    return published(spark, folder, "core/dim_customer").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_distinct("customer_key").alias("keys"),
        F.min("customer_key").alias("lowest"),
        F.max("customer_key").alias("highest"),
    )


# Key column of each fact: its parent in the warehouse, and fact column, parent and parent column in the SQL.
FOREIGN_KEYS = {
    ("fact_orders", "customer_key"): ("dim_customer", "f_orders", "customer_unique_id", "customer_unique_id"),
    ("fact_orders", "purchase_date_key"): ("dim_date", "f_orders", "purchase_date_key", "date_key"),
    ("fact_orders", "delivered_date_key"): ("dim_date", "f_orders", "delivered_date_key", "date_key"),
    ("fact_orders", "estimated_delivery_date_key"): ("dim_date", "f_orders", "estimated_delivery_date_key", "date_key"),
    ("fact_order_items", "customer_key"): ("dim_customer", "f_items", "customer_unique_id", "customer_unique_id"),
    ("fact_order_items", "product_key"): ("dim_product", "f_items", "product_id", "product_id"),
    ("fact_order_items", "seller_key"): ("dim_seller", "f_items", "seller_id", "seller_id"),
    ("fact_order_items", "purchase_date_key"): ("dim_date", "f_items", "purchase_date_key", "date_key"),
}


@query(
    "c4_published_orphans",
    " UNION ALL ".join(
        f"SELECT '{fact}.{column}' AS column_name, count(DISTINCT f.{child}) AS orphans FROM {table} f "
        f"ANTI JOIN {parent} p ON p.{key} = f.{child} WHERE f.{child} IS NOT NULL"
        for (fact, column), (parent, table, child, key) in FOREIGN_KEYS.items()
    ),
)
def published_orphans(spark, folder):
    """How many key values of each fact column lack their dimension row after two loads."""
    core = core_tables(spark, warehouse(spark, folder))
    counts = []
    for (fact, column), (parent, *_) in FOREIGN_KEYS.items():
        key = "date_key" if parent == "dim_date" else column
        orphans = checks.orphan_keys(core[fact], column, core[parent], key)
        counts.append(
            orphans.agg(F.count(F.lit(1)).alias("orphans")).select(
                F.lit(f"{fact}.{column}").alias("column_name"), "orphans"
            )
        )
    return reduce(DataFrame.unionByName, counts)


query(
    "r1_monthly_sales_published",
    pick("monthly", "year_month year month orders customers $revenue $freight $avg_order_value"),
)(lambda spark, folder: _published_report(spark, folder, "r1"))
query("r2_sales_by_category_published", pick("categories", "category items_sold orders $revenue $avg_item_price"))(
    lambda spark, folder: _published_report(spark, folder, "r2")
)
query(
    "r3_delivery_by_state_published",
    pick("states", "state delivered_orders $avg_delivery_days $late_pct $avg_review_score"),
)(lambda spark, folder: _published_report(spark, folder, "r3"))
query(
    "r4_seller_scorecard_published",
    pick("seller_card", "seller_id city state items_sold orders $revenue $avg_review_score"),
)(lambda spark, folder: _published_report(spark, folder, "r4"))
query("r5_payment_methods_published", pick("methods", "payment_type orders $total_paid $avg_installments"))(
    lambda spark, folder: _published_report(spark, folder, "r5")
)


def reports(core: dict[str, DataFrame]) -> dict:
    """The five reports over published tables, built on demand."""
    return {
        "r1": lambda: reporting.monthly_sales(core["fact_orders"], core["dim_date"]),
        "r2": lambda: reporting.sales_by_category(core["fact_order_items"], core["fact_orders"], core["dim_product"]),
        "r3": lambda: reporting.delivery_by_state(core["fact_orders"], core["dim_customer"]),
        "r4": lambda: reporting.seller_scorecard(core["fact_order_items"], core["fact_orders"], core["dim_seller"]),
        "r5": lambda: reporting.payment_methods(core["fact_orders"]),
    }


def _published_report(spark, folder, name: str) -> DataFrame:
    report = reports(core_tables(spark, warehouse(spark, folder)))[name]()
    return reporting.in_report_order(report, list(reporting.REPORT_ORDER)[int(name[1:]) - 1])


# ---- the trained model: rows only, its scores have no SQL counterpart


def _ml(spark, folder, table: str) -> DataFrame:
    tables = PublishedTables(spark, modelled(spark, folder))
    return tables.read(tables.latest(), f"ml/{table}")


query("l10_feature_importance")(
    lambda spark, folder: _ml(spark, folder, "feature_importance")
    .select("feature", "importance_pct")
    .orderBy(F.col("importance_pct").desc(), "feature")
)
query("l12_model_run")(
    lambda spark, folder: _ml(spark, folder, "model_runs").drop("run_id", "trained_at", "model_path")
)
query(
    "l15_prediction_counts",
    """SELECT data_split, count(*) AS orders, count(CASE WHEN is_late = 1 THEN 1 END) AS late FROM splits
       WHERE data_split IN ('test', 'open') GROUP BY data_split""",
)(
    lambda spark, folder: _ml(spark, folder, "order_late_predictions")
    .groupBy("data_split")
    .agg(F.count(F.lit(1)).alias("orders"), F.count_if("actual_is_late").alias("late"))
)


@query("l13_model_orders_at_risk")
def model_orders_at_risk(spark, folder):
    core = core_tables(spark, modelled(spark, folder))
    predictions = _ml(spark, folder, "order_late_predictions")
    return open_orders_at_risk(predictions, core["fact_orders"], core["dim_customer"])


@query("l14_model_deciles")
def model_deciles(spark, folder):
    return test_risk_deciles(_ml(spark, folder, "order_late_predictions")).orderBy("risk_group")


# ---- what is known of a model run without its scores

query(
    "l12_run_sizes",
    """SELECT count(CASE WHEN data_split = 'train' THEN 1 END) AS train_rows, count(CASE WHEN data_split = 'valid' THEN 1 END) AS valid_rows,
              count(CASE WHEN data_split = 'test' THEN 1 END) AS test_rows,
              (SELECT CAST(CAST(valid_from AS DATE) AS VARCHAR) FROM cuts) AS valid_from_date,
              (SELECT CAST(CAST(test_from AS DATE) AS VARCHAR) FROM cuts) AS test_from_date
       FROM splits""",
)(
    lambda spark, folder: _ml(spark, folder, "model_runs").select(
        "train_rows", "valid_rows", "test_rows", "valid_from_date", "test_from_date"
    )
)
query("l10_importance_total", "SELECT 17 AS features, 100 AS total_pct FROM (SELECT count(*) FROM splits)")(
    lambda spark, folder: _ml(spark, folder, "feature_importance").agg(
        F.count_distinct("feature").cast("int").alias("features"),
        F.round(F.sum("importance_pct")).cast("int").alias("total_pct"),
    )
)
query(
    "l14_model_decile_sizes",
    """SELECT CAST(risk_group AS INTEGER) AS risk_group, count(*) AS orders
       FROM (SELECT ntile(10) OVER (ORDER BY order_id) AS risk_group FROM splits WHERE data_split = 'test') GROUP BY risk_group""",
)(
    lambda spark, folder: test_risk_deciles(_ml(spark, folder, "order_late_predictions")).select(
        F.col("risk_group").cast("int").alias("risk_group"), "orders"
    )
)
