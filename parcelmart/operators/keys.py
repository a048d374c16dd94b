"""Surrogate keys and dimension upserts that keep every key a fact may point at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.operators.ordering import with_row_number


def number_new_rows(fresh: DataFrame, natural_key: str, surrogate_key: str, highest: int) -> DataFrame:
    """Dense keys after ``highest``, in natural-key order."""
    numbered = with_row_number(fresh, F.col(natural_key), name="_number", total="_total")
    return numbered.select((F.col("_number") + F.lit(highest)).alias(surrogate_key), *fresh.columns)


def dimension_changes(existing: DataFrame, source: DataFrame, natural_key: str) -> DataFrame:
    """Rows of ``source`` that ``existing`` does not hold as they are, and whether their key is ``known``."""
    attributes = [column for column in source.columns if column != natural_key]
    held = existing.select(F.col(natural_key).alias("_key"), F.struct(*attributes).alias("_held"))
    joined = source.join(held, source[natural_key] == F.col("_key"), "left")
    given = F.struct(*[source[a] for a in attributes])
    return joined.where(~F.col("_held").eqNullSafe(given)).select(*[source[c] for c in source.columns], F.col("_key").isNotNull().alias("known"))


def upsert_dimension(
    existing: DataFrame | None, source: DataFrame, natural_key: str, surrogate_key: str
) -> DataFrame:
    """Known keys take the attributes of ``source``, unknown ones get new keys, absent ones stay as they were."""
    if existing is None:
        return number_new_rows(source, natural_key, surrogate_key, 0)
    attributes = [column for column in source.columns if column != natural_key]
    found = source.select(F.col(natural_key), F.struct(*attributes).alias("_new"))
    known = existing.join(found, natural_key, "left").select(
        surrogate_key,
        natural_key,
        *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{a}")).otherwise(F.col(a)).alias(a) for a in attributes],
    )
    highest = existing.agg(F.max(surrogate_key)).first()[0] or 0
    unknown = source.join(existing.select(natural_key), natural_key, "left_anti").select(*source.columns)
    return known.unionByName(number_new_rows(unknown, natural_key, surrogate_key, highest))
