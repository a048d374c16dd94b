"""Seventeen analytic questions over the reports.

The inputs are aggregates (one row per month, category or state), so windows without a partition run over that
many rows, never over facts. Answers come in the order of the question; what it leaves open is settled by the row's own key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.functions.numbers import exact_ratio, percent

# Default first and last month of the analysis.
FIRST_MONTH, LAST_MONTH = "2017-01", "2018-08"


def _by_month():
    return Window.orderBy("year_month")


def _in_year():
    return Window.partitionBy("year")


def _in_year_by_month():
    return Window.partitionBy("year").orderBy("year_month")


def _best_of_year():
    return Window.partitionBy("year").orderBy(F.col("revenue").desc_nulls_first(), "year_month")


def _three_months():
    return _by_month().rowsBetween(-2, 0)


def _by_revenue():
    return Window.orderBy(F.col("revenue").desc_nulls_first())


def _by_revenue_then_name():
    return Window.orderBy(F.col("revenue").desc_nulls_first(), "category")


def _everything():
    return Window.partitionBy()


def in_months(monthly: DataFrame, first: str = FIRST_MONTH, last: str = LAST_MONTH) -> DataFrame:
    """Months of the inclusive range."""
    return monthly.where(F.col("year_month").between(first, last))


def revenue_per_year(months: DataFrame) -> DataFrame:
    return months.groupBy("year").agg(F.sum("revenue").alias("year_revenue")).orderBy("year")


def share_of_total(months: DataFrame) -> DataFrame:
    total = F.sum("revenue").over(_everything())
    return months.select(
        "year_month", "revenue", total.alias("total_revenue"), percent(F.col("revenue"), total, 1).alias("pct_of_total")
    ).orderBy("year_month")


def share_of_year(months: DataFrame) -> DataFrame:
    total = F.sum("revenue").over(_in_year())
    return months.select(
        "year", "year_month", "revenue", total.alias("year_revenue"),
        percent(F.col("revenue"), total, 1).alias("pct_of_year"),
    ).orderBy("year_month")


def running_totals(months: DataFrame) -> DataFrame:
    return months.select(
        "year_month",
        "revenue",
        F.sum("revenue").over(_by_month()).alias("running_total"),
        F.sum("revenue").over(_in_year_by_month()).alias("running_total_in_year"),
    ).orderBy("year_month")


def best_categories(categories: DataFrame, limit: int = 8) -> DataFrame:
    ranked = categories.select("category", "revenue", F.rank().over(_by_revenue()).alias("revenue_rank"))
    return ranked.orderBy("revenue_rank", "category").limit(limit)


def best_months_per_year(months: DataFrame, limit: int = 2) -> DataFrame:
    numbered = months.select("year", "year_month", "revenue", F.row_number().over(_best_of_year()).alias("rn"))
    return numbered.where(F.col("rn") <= limit).orderBy("year", "rn")


def month_over_month(months: DataFrame) -> DataFrame:
    previous = F.lag("revenue").over(_by_month())
    change = F.col("revenue") - previous
    return months.select(
        "year_month",
        "revenue",
        previous.alias("prev_month"),
        change.alias("change"),
        percent(change, previous, 1).alias("change_pct"),
        F.lead("revenue").over(_by_month()).alias("next_month"),
    ).orderBy("year_month")


def _average_orders(frame_of_rows) -> Column:
    return exact_ratio(F.sum("orders").over(frame_of_rows), F.count("orders").over(frame_of_rows))


def moving_average(months: DataFrame) -> DataFrame:
    return months.select(
        "year_month",
        "orders",
        F.round(_average_orders(_three_months()), 0).alias("moving_avg_3m"),
        F.count(F.lit(1)).over(_three_months()).alias("months_in_average"),
    ).orderBy("year_month")


def best_and_worst_month(months: DataFrame) -> DataFrame:
    """``last_value_trap`` uses the default frame, which ends at the current row and its equals."""
    by_revenue = Window.partitionBy("year").orderBy(F.col("revenue").desc_nulls_first())
    whole_year = _best_of_year().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return months.select(
        "year",
        "year_month",
        "revenue",
        F.first_value("year_month").over(_best_of_year()).alias("best_month"),
        (F.col("revenue") - F.first_value("revenue").over(_best_of_year())).alias("gap_to_best"),
        F.last_value("revenue").over(by_revenue).alias("last_value_trap"),
        F.last_value("revenue").over(whole_year).alias("worst_month_revenue"),
    ).orderBy("year", F.col("revenue").desc_nulls_first(), "year_month")


def category_quartiles(categories: DataFrame) -> DataFrame:
    return categories.select("category", "revenue", F.ntile(4).over(_by_revenue_then_name()).alias("quartile")).orderBy(F.col("revenue").desc_nulls_first(), "category")


def revenue_per_quartile(categories: DataFrame) -> DataFrame:
    return (
        category_quartiles(categories)
        .groupBy("quartile")
        .agg(F.count(F.lit(1)).alias("categories"), F.sum("revenue").alias("revenue"))
        .orderBy("quartile")
    )


def versus_average_month(months: DataFrame) -> DataFrame:
    """A month equal to the average counts as below it."""
    average = _average_orders(_in_year())
    return months.select(
        "year",
        "year_month",
        "orders",
        F.round(average, 0).alias("avg_orders_in_year"),
        (F.col("orders") - F.round(average, 0)).alias("difference"),
        F.when(F.col("orders") > average, "above average").otherwise("below average").alias("vs_average"),
    ).orderBy("year_month")


def biggest_categories_share(categories: DataFrame, limit: int = 5) -> DataFrame:
    """The share is of all revenue: the window runs before the limit."""
    share = percent(F.col("revenue"), F.sum("revenue").over(_everything()), 2)
    shares = categories.select("category", "revenue", share.alias("pct_of_total"))
    return shares.orderBy(F.col("revenue").desc_nulls_first(), "category").limit(limit)


def orders_year_to_date(months: DataFrame) -> DataFrame:
    return months.select("year_month", "orders", F.sum("orders").over(_in_year_by_month()).alias("orders_ytd")).orderBy("year_month")


def behind_previous_category(categories: DataFrame, limit: int = 5) -> DataFrame:
    behind = F.lag("revenue").over(_by_revenue_then_name()) - F.col("revenue")
    ranked = categories.select(
        F.rank().over(_by_revenue()).alias("revenue_rank"), "category", "revenue", behind.alias("behind_previous")
    )
    return ranked.orderBy("revenue_rank", "category").limit(limit)


def top_states(states: DataFrame, ranks: int = 3) -> DataFrame:
    """Equal states share a rank, so more than ``ranks`` rows may come back."""
    by_orders = Window.orderBy(F.col("delivered_orders").desc_nulls_first())
    ranked = states.select("state", "delivered_orders", F.rank().over(by_orders).alias("state_rank"))
    return ranked.where(F.col("state_rank") <= ranks).orderBy("state_rank", "state")


def months_above_moving_average(months: DataFrame) -> DataFrame:
    """Compared unrounded, shown rounded."""
    smoothed = months.select("year_month", "orders", _average_orders(_three_months()).alias("_average"))
    return smoothed.where(F.col("orders") > F.col("_average")).select(
        "year_month", "orders", F.round("_average", 0).alias("moving_avg_3m")
    ).orderBy("year_month")
