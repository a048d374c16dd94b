"""Spark session for local use, and the shared folder where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from parcelmart.sources.files import delete_folder, delete_on_exit


Result = TypeVar("Result")


def local_session(name: str = "parcelmart", cores: str = "8", memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests, the bench and single-machine use; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only a local session without one gets its own folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="parcelmart-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/parcelmart-{label}-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path


def written(frame: DataFrame, label: str, **options: int | str) -> DataFrame:
    """Write ``frame`` to the shared folder, with the writer's ``options``, and read it back.

    Cuts the lineage and freezes the rows: later jobs re-read the files when an executor is lost, and
    values such as generated row numbers cannot change between two uses. Parquet keeps the reads columnar.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.options(**options).parquet(path)
    result = spark.read.schema(frame.schema).parquet(path)
    result._scratch = path
    return result


def release(frame: DataFrame) -> None:
    """Delete the files of a table that ``written`` returned, once nothing that is still to run reads it."""
    if path := getattr(frame, "_scratch", None):
        delete_folder(frame.sparkSession, path)


def side_by_side(spark: SparkSession, jobs: Iterable[Callable[[], Result]]) -> list[Result]:
    """Start independent Spark jobs together, so that a small one does not wait for the tail of a large one.

    Results come back in the order of the jobs; the first failure is raised once all have ended.
    """
    jobs = [inheritable_thread_target(spark)(job) for job in jobs]
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = [pool.submit(job) for job in jobs]
    return [job.result() for job in running]


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings (double underscores for dots) for the jobs that run inside."""
    names = {key: key.replace("__", ".") for key in values}
    before = {key: spark.conf.get(name, None) for key, name in names.items()}
    for key, name in names.items():
        spark.conf.set(name, values[key])
    try:
        yield
    finally:
        for key, name in names.items():
            spark.conf.unset(name) if before[key] is None else spark.conf.set(name, before[key])
