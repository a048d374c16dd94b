"""Published versions of a set of parquet tables.

A run writes only new folders. When every table is written and checked, one small pointer file lists the folders
that make up the new version. Readers see the old version or the new one, never a mixture, and a failed run
leaves nothing visible. A large fact table is laid out by month, and a version lists each month's folder
separately, so an incremental run rewrites the months it touched and points at the old folders for the rest.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.sources.files import child_names, delete_folder, exists, publish_text, read_text

RUN_FOLDER = "run"
CODEC = "zstd"


@dataclass
class Version:
    """The folders (relative to the root) that hold each table in one published version."""

    run_id: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    #: Place in the line of published versions; a draft takes the place behind the version it started from.
    number: int = 0
    #: Columns that tables got after their first folders: name, type, default (SQL) and the run since which folders hold it.
    added: dict[str, list[dict]] = field(default_factory=dict)


class PublishedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _pointer(self, number: int) -> str:
        return f"{self.root}/_published/{number:08d}.json"

    def _published(self) -> list[int]:
        names = child_names(self.spark, f"{self.root}/_published")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def _version(self, number: int) -> Version:
        return Version(**json.loads(read_text(self.spark, self._pointer(number))))

    def latest(self) -> Version:
        numbers = self._published()
        return self._version(numbers[-1]) if numbers else Version()

    def next_run_id(self) -> int:
        """One more than any run that was started, finished or not, so that no folder is written twice."""
        started = [int(name) for name in child_names(self.spark, f"{self.root}/_runs") if name.isdigit()]
        run_id = max([self.latest().run_id, *started]) + 1
        publish_text(self.spark, f"{self.root}/_runs/{run_id:08d}", "")
        return run_id

    def read(self, version: Version, table: str) -> DataFrame | None:
        """The table in this version, or None when no run has published it yet."""
        if table not in version.folders:
            return None
        schema = T.StructType.fromJson(version.schemas[table])
        if not version.folders[table]:
            return self.spark.createDataFrame([], schema)
        groups: dict[tuple[str, ...], list[str]] = {}
        added = {column["name"]: column for column in version.added.get(table, [])}
        for folder in version.folders[table]:
            run = int(folder.removeprefix(f"{table}/{RUN_FOLDER}=").split("/")[0])
            missing = tuple(name for name, column in added.items() if run < column["since"])
            groups.setdefault(missing, []).append(f"{self.root}/{folder}")
        parts = []
        for missing, paths in groups.items():
            held = T.StructType([f for f in schema.fields if f.name not in missing])
            part = self.spark.read.schema(held).option("basePath", f"{self.root}/{table}").parquet(*paths)
            defaults = {name: F.expr(added[name]["default"]).cast(added[name]["type"]) for name in missing}
            parts.append(part.withColumns(defaults).select(*schema.fieldNames()) if defaults else part.select(*schema.fieldNames()))
        return reduce(DataFrame.unionByName, parts)

    def add_column(self, version: Version, table: str, name: str, kind: str, default: str = "NULL") -> None:
        """Give a table a column that its folders do not hold yet; they are read with the default, a SQL literal.

        Nothing is written: folders of this run and later ones hold the column, the others stay as they are.
        """
        schema = T.StructType.fromJson(version.schemas[table])
        if name in schema.fieldNames():
            return
        version.schemas[table] = schema.add(name, T.DataType.fromDDL(kind)).jsonValue()
        column = {"name": name, "type": kind, "default": default, "since": version.run_id}
        version.added[table] = [*version.added.get(table, []), column]

    def write(self, version: Version, table: str, frame: DataFrame) -> DataFrame:
        """Write a whole table as part of ``version`` and read it back."""
        folder = f"{table}/{RUN_FOLDER}={version.run_id}"
        frame.write.parquet(f"{self.root}/{folder}", compression=CODEC)
        version.folders[table] = [folder]
        version.schemas[table] = frame.schema.jsonValue()
        return self.read(version, table)

    def append(self, version: Version, table: str, frame: DataFrame) -> DataFrame:
        """Add rows to the table as it was in the previous version."""
        earlier = version.folders.get(table, [])
        self.write(version, table, frame)
        version.folders[table] = [*earlier, *version.folders[table]]
        return self.read(version, table)

    def write_parts(
        self, version: Version, table: str, frame: DataFrame, part: str, replaced: set[int]
    ) -> DataFrame:
        """Replace the parts listed in ``replaced`` by the rows of ``frame``; keep the folders of all others.

        The rebalance hint lets adaptive execution cut a part that holds a large share of the rows into several
        tasks and merge the small ones, so neither one huge task nor many tiny files appear.
        """
        folder = f"{table}/{RUN_FOLDER}={version.run_id}"
        frame.hint("rebalance", part).write.partitionBy(part).parquet(f"{self.root}/{folder}", compression=CODEC)
        kept = [old for old in version.folders.get(table, []) if int(old.rsplit("=", 1)[1]) not in replaced]
        written = [
            f"{folder}/{name}"
            for name in child_names(self.spark, f"{self.root}/{folder}")
            if name.startswith(f"{part}=")
        ]
        version.folders[table] = [*kept, *written]
        version.schemas[table] = frame.schema.jsonValue()
        return self.read(version, table)

    def draft(self) -> Version:
        """A new unpublished version that starts out with the folders of the latest one."""
        latest = self.latest()
        return Version(
            run_id=self.next_run_id(),
            folders={table: list(folders) for table, folders in latest.folders.items()},
            schemas=dict(latest.schemas),
            added=dict(latest.added),
            number=latest.number + 1,
        )

    def publish(self, version: Version) -> None:
        """Make ``version`` the latest one; fails if any run published since its draft began.

        A draft holds the folders of the version it started from, so publishing it over a newer one would take back
        that one's tables. Both would have the same number, and only one file of a name can be created.
        """
        overtaken = RuntimeError(f"run {version.run_id} was overtaken by another run")
        if self.latest().number + 1 != version.number:
            raise overtaken
        pointer = self._pointer(version.number)
        try:
            publish_text(self.spark, pointer, json.dumps(vars(version), indent=1))
        except Py4JJavaError as failure:
            if exists(self.spark, pointer):
                raise overtaken from failure
            raise

    def expire(self, keep: int) -> None:
        """Delete what none of the last ``keep`` published versions uses; unfinished newer runs are left alone."""
        numbers = self._published()
        kept = [self._version(number) for number in numbers[-keep:]]
        for number in numbers[:-keep]:
            delete_folder(self.spark, self._pointer(number))
        used = {folder for version in kept for folders in version.folders.values() for folder in folders}
        for table in {table for version in kept for table in version.folders}:
            for name in child_names(self.spark, f"{self.root}/{table}"):
                if not name.startswith(f"{RUN_FOLDER}=") or int(name.split("=")[1]) > kept[-1].run_id:
                    continue
                folder = f"{table}/{name}"
                parts = [f"{folder}/{part}" for part in child_names(self.spark, f"{self.root}/{folder}") if "=" in part]
                if folder in used or used.issuperset(parts) and parts:
                    continue
                unused = [part for part in parts if part not in used] if used & set(parts) else [folder]
                for path in unused:
                    delete_folder(self.spark, f"{self.root}/{path}")
