"""Deliveries arrive as folders of the eight CSV files, complete or with new and changed rows only.

Nothing in the warehouse is dropped by a load, so a delivery may hold changes only: an order comes with its own
customer row, lines, payments and reviews. A delivery without orders is loaded too, for its other tables. The stream
remembers which deliveries it has seen; one that was published right before a crash is offered again and finds an empty
batch, and one whose other files are not there yet stops the stream with an error and is offered again by the next call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.plans.load import LoadResult, csv_sources, run_load
from parcelmart.sources.staging import COLUMNS


def delivery_paths(folder: str) -> dict[str, str]:
    return {table: f"{folder}/{table}.csv" for table in COLUMNS}


def load_deliveries(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    on_load: Callable[[str, LoadResult], None] | None = None,
) -> None:
    """Load each delivery folder under ``landing`` that is new since the last call, in name order within a batch."""
    # One row for each file, whatever it holds: only its name is asked for, so no content is read.
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", 1)
        .load(f"{landing.rstrip('/')}/*/orders.csv")
        .select(F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"))
    )

    def load(rows: DataFrame, _batch_id: int) -> None:
        # One name per delivery that arrived since the last batch.
        for row in rows.distinct().orderBy("folder").collect():
            result = run_load(spark, root, csv_sources(spark, delivery_paths(row.folder)))
            if on_load:
                on_load(row.folder, result)

    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
