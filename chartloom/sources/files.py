"""Small files and file facts on whatever file system Spark is using."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def facts(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of every file named, and of the files in every folder named."""
    found = []
    for path in paths:
        at, system = _system(spark, path)
        for status in system.listStatus(at):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text; None if there is no such file."""
    at, system = _system(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Give the file a new text in one step: readers see the old one or the new one, whole."""
    context = spark.sparkContext
    jvm = context._jvm
    fresh, system = _system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = context._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), context._jsc.hadoopConfiguration())
    files.rename(system.makeQualified(fresh), system.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds, unless the session has ended already."""
    if spark.sparkContext._jsc is None:
        return
    at, system = _system(spark, path)
    system.delete(at, True)
