"""Exact decimal arithmetic: half-up rounding on decimals, never on binary doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_int(text: Column) -> Column:
    """Text or number to int, rounding half away from zero (a plain cast would truncate)."""
    return F.round(text.cast("decimal(20,4)"), 0).cast("int")


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal quotient with 14 digits after the point; null instead of an error on a zero divisor."""
    divisor = F.nullif(denominator.cast("decimal(22,2)"), F.lit(0).cast("decimal(22,2)"))
    return numerator.cast("decimal(24,2)") / divisor


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    return F.round(exact_ratio(numerator, denominator), digits)


def rounded_average(value: Column, digits: int) -> Column:
    """AVG that ignores nulls, rounded on the exact decimal quotient."""
    return rounded_ratio(F.sum(value), F.count(value), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return rounded_ratio(part.cast("decimal(22,2)") * F.lit(100), whole, digits)


def guarded_fraction(numerator: Column, denominator: Column) -> Column:
    """Double quotient where the denominator is positive, null elsewhere."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))
