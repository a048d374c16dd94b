"""One run of the warehouse: stage the sources, update dimensions and facts, check, publish.

All tables of a run go to new folders; the version pointer is the last thing written, so a failed check or a lost
driver leaves the previous version, watermark included, as it was.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelmart.functions.dates import date_key, month_of_key
from parcelmart.operators import checks
from parcelmart.operators.keys import dimension_changes, number_new_rows, upsert_dimension
from parcelmart.plans import dimensions, facts
from parcelmart.plans.batch import batch_summary, moved_watermark, seed_watermark, select_batch
from parcelmart.shared import release, settings, side_by_side, written
from parcelmart.sources.published import PublishedTables, Version
from parcelmart.sources.staging import COLUMNS, read_csv, require_files, typed

MONTH = "month_part"
#: Folders that a dimension may consist of before it is written as a whole again.
FOLDERS = 16

# Columns that must hold a value, and the allowed change types.
REQUIRED = {
    "dim_customer": ["customer_key", "customer_unique_id"],
    "dim_product": ["product_key", "product_id", "category_name_pt", "category_name_en"],
    "dim_seller": ["seller_key", "seller_id"],
    "fact_orders": ["customer_key", "purchase_date_key", "order_status", "items_count", "items_value", "freight_value"],
    "fact_order_items": ["customer_key", "product_key", "seller_key", "purchase_date_key", "price", "freight_value"],
}
CHANGE_TYPES = ["new", "changed"]
# A later batch is a small part of all orders: a Bloom filter of its orders, whatever the tables' sizes, keeps the rows of
# all others out of the shuffles.
BATCH_FILTER = {
    "spark__sql__optimizer__runtime__bloomFilter__enabled": "true",
    "spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "0",
    "spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold": "1g",
}
# Columns that fact_orders got later: a warehouse that was loaded before them has them filled, with the run's time or nothing.
LATER_COLUMNS = [("order_updated_at", "timestamp_ntz", None), ("etl_inserted_at", "timestamp", "run"), ("etl_updated_at", "timestamp", "run")]


@dataclass
class LoadResult:
    version: Version
    rows_loaded: dict[str, int]
    rows_new: int
    rows_changed: int


def csv_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The raw files as text tables; fails when one is missing."""
    require_files(spark, paths)
    return {table: read_csv(spark, table, path) for table, path in paths.items()}


def stage(tables: PublishedTables, version: Version, sources: dict[str, DataFrame]) -> dict[str, int]:
    """Replace the staging snapshot; the row counts are observed while writing."""

    def write(table: str) -> int:
        observed = Observation(f"staged_{table}")
        tables.write(version, f"staging/{table}", sources[table].observe(observed, F.count(F.lit(1)).alias("rows")))
        return observed.get["rows"]

    return dict(zip(COLUMNS, side_by_side(tables.spark, (partial(write, table) for table in COLUMNS)), strict=True))


def update_dimensions(tables: PublishedTables, version: Version, staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions of the new version. One that did not change keeps its folders, new keys are appended to it as a folder
    of their own, and only changed attributes, or more than ``FOLDERS`` folders, have it written as a whole.
    """

    def days() -> DataFrame:
        existing = tables.read(version, "core/dim_date")
        calendar = dimensions.dim_date(staged["orders"], existing)
        if existing is not None and existing.count() == calendar.count():  # it only ever grows at its ends
            return existing
        return tables.write(version, "core/dim_date", calendar)

    def keyed(name: str, source: DataFrame, natural_key: str) -> DataFrame:
        table, surrogate_key = f"core/{name}", name.removeprefix("dim_") + "_key"
        existing = tables.read(version, table)
        if existing is not None:
            source = written(source, name)  # read up to three times from here on
            changes = written(dimension_changes(existing, source, natural_key), "changes")
            counts = changes.agg(F.count_if(~F.col("known")).alias("new"), F.count_if("known").alias("changed")).first()
            if not counts.new and not counts.changed:
                return existing
            if not counts.changed and len(version.folders[table]) < FOLDERS:
                highest = existing.agg(F.max(surrogate_key)).first()[0] or 0
                fresh = number_new_rows(changes.drop("known"), natural_key, surrogate_key, highest)
                fresh = written(fresh.select(*existing.columns), "fresh")
                checks.require_keyed(fresh, [natural_key], REQUIRED[name], name)  # none of the new keys is known
                return tables.append(version, table, fresh)
        whole = tables.write(version, table, upsert_dimension(existing, source, natural_key, surrogate_key))
        checks.require_keyed(whole, [natural_key], REQUIRED[name], name)
        return whole

    customer = dimensions.dim_customer(staged["customers"], staged["orders"])
    product = dimensions.dim_product(staged["products"], staged["category_translation"])
    seller = dimensions.dim_seller(staged["sellers"])
    built = side_by_side(
        tables.spark,
        [
            days,
            partial(keyed, "dim_customer", customer, "customer_unique_id"),
            partial(keyed, "dim_product", product, "product_id"),
            partial(keyed, "dim_seller", seller, "seller_id"),
        ],
    )
    return dict(zip(["dim_date", "dim_customer", "dim_product", "dim_seller"], built, strict=True))


def _replace_batch(
    tables: PublishedTables,
    version: Version,
    name: str,
    fresh: DataFrame,
    batch: DataFrame,
    months: set[int],
) -> DataFrame:
    """Rows of batch orders are exchanged for ``fresh``; only the months the batch touches are rewritten."""
    table = f"core/{name}"
    existing = tables.read(version, table)
    merged = fresh.withColumn(MONTH, month_of_key(F.col("purchase_date_key")))
    if existing is not None and months:
        untouched = existing.where(F.col(MONTH).isin(*months)).join(batch.select("order_id"), "order_id", "left_anti")
        merged = untouched.select(*merged.columns).unionByName(merged)
    return tables.write_parts(version, table, merged, MONTH, months)


def _with_load_times(fresh: DataFrame, existing: DataFrame | None, months: set[int], run_ts: datetime) -> DataFrame:
    """A known order keeps the time it was first loaded."""
    now = F.lit(run_ts).cast("timestamp")
    if existing is None or not months:
        return fresh.withColumns({"etl_inserted_at": now, "etl_updated_at": now})
    first_loaded = existing.where(F.col(MONTH).isin(*months)).select("order_id", "etl_inserted_at")
    return fresh.join(first_loaded, "order_id", "left").withColumns(
        {"etl_inserted_at": F.coalesce("etl_inserted_at", now), "etl_updated_at": now}
    )


def _touched_months(batch: DataFrame) -> set[int]:
    """Months the batch orders are in now or were in before: at most one value per calendar month."""
    keys = F.array(date_key(F.col("order_purchase_timestamp")), F.col("loaded_date_key"))
    days = batch.select(F.explode(keys).alias("day")).where(F.col("day").isNotNull())
    return {row.month for row in days.select(month_of_key(F.col("day")).alias("month")).distinct().collect()}


def _check_facts(orders: DataFrame, items: DataFrame, dim_date: DataFrame, months: set[int]) -> None:
    """Required columns and calendar keys of the months that were written.

    Customer, product and seller keys come out of inner joins with their dimensions, and the row counts are
    compared, so those cannot dangle.
    """

    def in_calendar(name: str, fact: DataFrame, column: str) -> None:
        orphans = checks.orphan_keys(fact, column, dim_date, "date_key")
        checks.require_none(orphans, f"{name}: {column} outside the calendar")

    jobs = []
    for name, fact in (("fact_orders", orders), ("fact_order_items", items)):
        touched = fact.where(F.col(MONTH).isin(*months))
        jobs.append(partial(checks.require_no_nulls, touched, *REQUIRED[name]))
        jobs += [partial(in_calendar, name, touched, c) for c in fact.columns if c.endswith("date_key")]
    side_by_side(orders.sparkSession, jobs)


def in_batch(frame: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of batch orders. Every batch order has a change type; the condition tells Spark that few orders are wanted."""
    wanted = batch.where(F.col("change_type").isin(CHANGE_TYPES)).select("order_id")
    return frame.join(wanted, "order_id", "left_semi")


def _update_facts(
    tables: PublishedTables,
    version: Version,
    staged: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    batch: DataFrame,
    batch_size: int,
    run_ts: datetime,
) -> None:
    """Recompute the batch orders and their lines, exchange them in both facts, and check the result."""
    known_orders = tables.read(version, "core/fact_orders")
    months = _touched_months(batch)

    def of_batch(frame: DataFrame) -> DataFrame:
        """The rows of batch orders. The first batch holds all orders there are, so nothing is looked up for it."""
        return frame if known_orders is None else in_batch(frame, batch)

    keyed_orders = facts.order_customers(batch, staged["customers"], dims["dim_customer"])
    keyed_orders = tables.write(version, "etl/keyed_orders", keyed_orders)
    checks.require_same_count(
        batch_size, keyed_orders.count(), "fact_orders: orders of the batch lack their customer or have several"
    )

    order_keys = keyed_orders.withColumn("purchase_date_key", date_key(F.col("order_purchase_timestamp")))
    lines = staged["order_items"]
    lines = lines if known_orders is None else written(in_batch(lines, batch), "lines")
    fresh_items = facts.order_items(lines, order_keys, dims["dim_product"], dims["dim_seller"])
    items = _replace_batch(tables, version, "fact_order_items", fresh_items, batch, months)
    loaded_items = of_batch(items.where(F.col(MONTH).isin(*months)))
    loaded_lines = checks.require_keyed(
        loaded_items, ["order_id", "order_item_id"], REQUIRED["fact_order_items"], "fact_order_items"
    )
    batch_lines = lines.count()
    if batch_lines != loaded_lines:
        batch_lines = in_batch(lines, batch).count()  # lines without an order in the source are not missed
    checks.require_same_count(batch_lines, loaded_lines, "fact_order_items: lines of the batch")
    release(lines)

    fresh_orders = facts.order_facts(
        keyed_orders,
        loaded_items,
        of_batch(staged["order_payments"]),
        of_batch(staged["order_reviews"]),
    )
    fresh_orders = _with_load_times(fresh_orders, known_orders, months, run_ts)
    orders = _replace_batch(tables, version, "fact_orders", fresh_orders, batch, months)
    loaded = of_batch(orders.where(F.col(MONTH).isin(*months)))
    loaded_orders = checks.require_keyed(loaded, ["order_id"], REQUIRED["fact_orders"], "fact_orders")
    checks.require_same_count(batch_size, loaded_orders, "fact_orders: orders of the batch after the write")

    _check_facts(orders, items, dims["dim_date"], months)


def run_load(
    spark: SparkSession,
    root: str,
    sources: dict[str, DataFrame],
    full_refresh: bool = False,
    run_ts: datetime | None = None,
    keep_versions: int = 5,
) -> LoadResult:
    """Load ``sources`` (the eight staging tables, as text or typed) into the warehouse at ``root``.

    Folders that none of the last ``keep_versions`` published versions uses are deleted after publishing.
    """
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled must be true: malformed source text has to stop the load")
    run_ts = run_ts or datetime.now(UTC)
    tables = PublishedTables(spark, root)
    version = tables.draft()
    if "core/fact_orders" in version.folders:
        for name, kind, default in LATER_COLUMNS:
            literal = f"TIMESTAMP '{run_ts:%Y-%m-%d %H:%M:%S.%f%z}'" if default else "NULL"
            tables.add_column(version, "core/fact_orders", name, kind, literal)
    rows_loaded = stage(tables, version, sources)
    staged = {table: typed(table, tables.read(version, f"staging/{table}")) for table in COLUMNS}

    known_orders = tables.read(version, "core/fact_orders")
    watermark = seed_watermark(spark, tables.read(version, "etl/watermark"), run_ts)
    dims = update_dimensions(tables, version, staged)

    selected = select_batch(staged["orders"], staged["order_reviews"], known_orders, watermark, full_refresh)
    batch = tables.write(version, "etl/orders_batch", selected)
    needed = ["order_updated_at", "order_status", "order_purchase_timestamp"]
    batch_size = checks.require_keyed(batch, ["order_id"], needed, "orders_batch")
    checks.require_none(checks.outside_domain(batch, "change_type", CHANGE_TYPES), "unknown change type")
    if batch_size or known_orders is None:
        with settings(spark, **({} if known_orders is None else BATCH_FILTER)):
            _update_facts(tables, version, staged, dims, batch, batch_size, run_ts)

    summary = batch_summary(batch, watermark)
    log = summary.withColumns({"run_at": F.lit(run_ts).cast("timestamp"), "full_refresh": F.lit(full_refresh)})
    tables.append(version, "etl/load_log", log.withColumn("log_id", F.lit(version.run_id).cast("bigint")))
    tables.write(version, "etl/watermark", moved_watermark(watermark, summary, run_ts))
    counts = summary.first()
    tables.publish(version)
    tables.expire(keep_versions)
    return LoadResult(version, rows_loaded, counts.rows_new, counts.rows_changed)


def core_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published star schema."""
    tables = PublishedTables(spark, root)
    version = tables.latest()
    return {
        name.removeprefix("core/"): tables.read(version, name) for name in version.folders if name.startswith("core/")
    }
