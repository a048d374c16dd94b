"""One row per key. ``max_by`` combines on the map side, so a hot key costs one row per task in the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(frame: DataFrame, key: str, columns: list[str], moment: Column, tie_break: Column) -> DataFrame:
    """The row with the greatest ``moment`` per key. Null moments sort below every dated one."""
    ordering = F.struct(moment.alias("moment"), tie_break.alias("tie_break"))
    picked = F.max_by(F.struct(*columns), ordering)
    return frame.groupBy(key).agg(picked.alias("_picked")).select(key, *[F.col(f"_picked.{c}") for c in columns])


def first_by(value: Column, sequence: Column) -> Column:
    """Aggregate: the value at the lowest sequence; a null sequence comes last, as in an ascending sort."""
    return F.min_by(value, F.struct(sequence.isNull().alias("missing"), sequence.alias("sequence"), value.alias("value")))
