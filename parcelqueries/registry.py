"""Every registered query with the SQL that gives its expected answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelqueries.sql_tables import with_tables

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
EXPECTED: dict[str, str] = {}


def present(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as ISO text: types both engines hand over alike."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            column = column.cast("string")
        return column.alias(field.name)

    return frame.select(*[shown(field) for field in frame.schema.fields])


def pick(table: str, columns: str, tail: str = "") -> str:
    """SELECT over a named table: ``$x`` is shown as a double, ``@x`` as text."""

    def shown(name: str) -> str:
        if name.startswith("$"):
            return f"CAST({name[1:]} AS DOUBLE) AS {name[1:]}"
        if name.startswith("@"):
            return f"CAST({name[1:]} AS VARCHAR) AS {name[1:]}"
        return name

    return f"SELECT {', '.join(shown(name) for name in columns.split())} FROM {table} {tail}"


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; without ``sql`` only its rows are checked."""

    def register(build: Build) -> Build:
        QUERIES[name] = lambda spark, folder: present(build(spark, folder))
        if sql is not None:
            EXPECTED[name] = with_tables(sql)
        return build

    return register
