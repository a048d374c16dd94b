"""Data-quality checks. Each returns the offending rows or counts; ``require_*`` raises on any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(Exception):
    """A load or model run is not allowed to publish."""


def duplicate_keys(frame: DataFrame, *key: str) -> DataFrame:
    return frame.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def orphan_keys(frame: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null values of ``column`` that the parent does not hold.

    The values are made distinct before the join: a value that fills a third of the child is one row by then. The parent's
    keys are shuffled, however small their packed files make them look: sent whole, they would pass through the driver.
    """
    values = frame.where(F.col(column).isNotNull()).select(F.col(column).alias("missing_key")).distinct()
    return values.join(parent.select(F.col(parent_key).alias("missing_key")).hint("merge"), "missing_key", "left_anti")


def null_counts(frame: DataFrame, *columns: str) -> DataFrame:
    """One row: how many nulls each column holds, counted in one pass."""
    return frame.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])


def key_summary(frame: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """One row from one pass: all rows, the most rows any key has, and the nulls of each required column."""
    per_key = frame.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(column).isNull()).alias(f"_{column}") for column in required],
    )
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("_rows"), F.lit(0)).alias("rows_per_key"),
        *[F.coalesce(F.sum(f"_{column}"), F.lit(0)).alias(column) for column in required],
    )


def outside_domain(frame: DataFrame, column: str, allowed: list) -> DataFrame:
    """Non-null values other than the allowed ones, with their row counts."""
    return (
        frame.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def require_none(violations: DataFrame, message: str) -> None:
    example = violations.limit(1).collect()
    if example:
        raise CheckFailed(f"{message}, for example {example[0].asDict()}")


def require_keyed(frame: DataFrame, key: list[str], required: list[str], name: str) -> int:
    """Unique key and no nulls in the required columns; returns the number of rows."""
    found = key_summary(frame, key, required).first().asDict()
    rows = found.pop("rows")
    if found.pop("rows_per_key") > 1:
        raise CheckFailed(f"{name}: {', '.join(key)} repeats")
    empty = {column: rows for column, rows in found.items() if rows}
    if empty:
        raise CheckFailed(f"{name}: null in columns that need a value: {empty}")
    return rows


def require_no_nulls(frame: DataFrame, *columns: str) -> None:
    counts = null_counts(frame, *columns).first().asDict()
    empty = {column: rows for column, rows in counts.items() if rows}
    if empty:
        raise CheckFailed(f"null in columns that need a value: {empty}")


def require_same_count(staged: int, loaded: int, message: str) -> None:
    if staged != loaded:
        raise CheckFailed(f"{message}: {staged} staged but {loaded} loaded")
