"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO day numbers of Saturday and Sunday (Monday is 1).
WEEKEND_DAYS = (6, 7)


def date_key(moment: Column) -> Column:
    """Date or timestamp to an int like 20180131; null stays null."""
    day = moment.cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def days_between(later: Column, earlier: Column) -> Column:
    """Whole calendar days; the times of day do not count."""
    return F.datediff(later.cast("date"), earlier.cast("date"))


def month_of_key(key: Column) -> Column:
    """20180131 -> 201801."""
    return F.floor(key / 100).cast("int")
