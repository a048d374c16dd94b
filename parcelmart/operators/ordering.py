"""Whole-table ordering without pulling the table into one task.

An unpartitioned window function sends every row to a single task. Here the rows are range-partitioned on a total
order, numbered inside each slice, and written once; the per-slice counts or sums (one row per slice, so at most
``spark.sql.shuffle.partitions`` rows) then give each slice its offset. The order must end in a unique column, so
that a value shared by a third of the rows is still spread over many slices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.shared import written

# monotonically_increasing_id puts the partition number above bit 33 and the row position below it.
_POSITION_BITS = 33
#: Parts that a range of values is cut into while a quantile is looked for.
STEPS = 4096


def _sliced(frame: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows with their slice number and their position inside the slice."""
    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = written(ordered.withColumn("_slot", F.monotonically_increasing_id()), label)
    return numbered.select(
        *frame.columns,
        F.shiftright("_slot", _POSITION_BITS).alias("_slice"),
        F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1).alias("_position"),
    )


def with_row_number(frame: DataFrame, *order: Column, name: str = "row_number", total: str = "row_count") -> DataFrame:
    """Add the 1-based rank of each row in a total order, and the number of rows."""
    sliced = _sliced(frame, list(order), "numbered")
    earlier_slices = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_slice",
            F.coalesce(F.sum("_rows").over(earlier_slices), F.lit(0)).alias("_offset"),
            F.sum("_rows").over(Window.partitionBy()).alias(total),
        )
    )
    # One row per slice: bounded by the number of shuffle partitions.
    return sliced.join(F.broadcast(offsets), "_slice").select(
        *frame.columns, (F.col("_offset") + F.col("_position") + 1).alias(name), total
    )


def with_running_totals(frame: DataFrame, order: list[Column], totals: dict[str, str]) -> DataFrame:
    """Add running sums over a total order; ``totals`` maps each new column to the column it sums."""
    sliced = _sliced(frame, order, "totals")
    earlier_slices = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(*[F.sum(source).alias(f"_sum_{new}") for new, source in totals.items()])
        .select(
            "_slice",
            *[F.coalesce(F.sum(f"_sum_{new}").over(earlier_slices), F.lit(0)).alias(f"_before_{new}") for new in totals],
        )
    )
    inside = Window.partitionBy("_slice").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    return sliced.join(F.broadcast(offsets), "_slice").select(
        *frame.columns,
        *[(F.sum(source).over(inside) + F.col(f"_before_{new}")).alias(new) for new, source in totals.items()],
    )


def with_ntile(frame: DataFrame, buckets: int, *order: Column, name: str = "bucket") -> DataFrame:
    """NTILE(buckets) over the whole table: the first ``count % buckets`` buckets hold one row more."""
    numbered = with_row_number(frame, *order, name="_rank", total="_total")
    index = F.col("_rank") - 1
    size = F.floor(F.col("_total") / buckets)
    larger = F.col("_total") % buckets
    in_larger = larger * (size + 1)
    bucket = F.when(index < in_larger, F.floor(index / (size + 1))).otherwise(
        larger + F.floor((index - in_larger) / F.greatest(size, F.lit(1)))
    )
    return numbered.select(*frame.columns, (bucket + 1).cast("int").alias(name))


def quantile(frame: DataFrame, value: str, fraction: float, name: str = "quantile") -> DataFrame:
    """One row: the exact quantile, interpolated linearly between the two neighbouring values."""
    return quantiles(frame, value, {name: fraction})


def quantiles(frame: DataFrame, value: str, fractions: dict[str, float]) -> DataFrame:
    """One row with an exact quantile for each name, by selection: the rows are read once, and never sorted.

    Spark's ``percentile`` keeps every distinct value in one task, which a score column does not survive. Equal values are
    counted; then the range that holds a wanted rank is cut into ``STEPS`` parts of which only counts, least and largest
    value are fetched, again and again, until a part holds one value. All fractions share the passes.
    """
    counted = frame.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = counted.groupBy(F.col(value).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    counted = written(counted, "counted")
    rows, low, high = counted.agg(F.sum("_rows"), F.min("_value"), F.max("_value")).first()
    schema = ", ".join(f"{name} double" for name in fractions)
    if not rows:
        return frame.sparkSession.createDataFrame([(None,) * len(fractions)], schema)
    positions = {name: (rows - 1) * fraction for name, fraction in fractions.items()}
    ranks = {place for p in positions.values() for place in (math.floor(p), math.ceil(p))}
    found = _at_ranks(counted, ranks, low, high)
    between = {name: (found[math.floor(p)], found[math.ceil(p)], p - math.floor(p)) for name, p in positions.items()}
    return frame.sparkSession.createDataFrame([tuple(a + (b - a) * part for a, b, part in between.values())], schema)


def _at_ranks(counted: DataFrame, ranks: set[int], low: float, high: float) -> dict[int, float]:
    """The value at each 0-based rank of ``counted`` (``_value``, ``_rows``), whose values lie from ``low`` to ``high``."""
    found, open_ = {}, dict.fromkeys(ranks, (low, high, 0))  # a range of values, and the rows below it
    while open_:
        found |= {rank: low for rank, (low, high, _) in open_.items() if low == high}
        open_ = {rank: span for rank, span in open_.items() if rank not in found}
        spans = sorted(set(open_.values()))
        if not spans:
            break
        of, step, inside = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(False)
        for number, (low, high, _) in enumerate(spans):
            here = F.col("_value").between(low, high)
            half = 2.0 if math.isinf(high - low) else 1.0  # halves do not overflow
            share = (F.col("_value") / half - low / half) / (high / half - low / half)
            of, step, inside = F.when(here, number).otherwise(of), F.when(here, share).otherwise(step), inside | here
        part = F.least(F.floor(step * STEPS), F.lit(STEPS - 1)).alias("part")
        sums = [F.sum("_rows").alias("rows"), F.min("_value").alias("low"), F.max("_value").alias("high")]
        parts = counted.where(inside).groupBy(of.alias("span"), part).agg(*sums).orderBy("span", "part").collect()
        for rank, span in open_.items():
            below = span[2]
            for row in (r for r in parts if r["span"] == spans.index(span)):
                if rank < below + row["rows"]:
                    open_[rank] = (row["low"], row["high"], below)
                    break
                below += row["rows"]
    return found
