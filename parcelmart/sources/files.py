"""The few file operations the jobs need, on whatever file system the path belongs to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty when it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(entry.getPath().getName() for entry in _file_system(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make ``path`` appear with its whole content at once; fail if it is already there."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"  # two writers of one path do not share it
    stream = _file_system(spark, draft).create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    context.rename(_path(spark, draft), _path(spark, path), no_options)


def delete_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).deleteOnExit(_path(spark, path))


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Path, length and modification time of every file in ``folder``: differs when its content was replaced."""
    entries = _file_system(spark, folder).listStatus(_path(spark, folder))
    return tuple(sorted((e.getPath().toString(), e.getLen(), e.getModificationTime()) for e in entries))
