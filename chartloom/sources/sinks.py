"""Stored, refreshable outputs."""

from __future__ import annotations

import atexit
import contextlib
import functools
import json
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .files import read_text, remove, replace_text


class Sink(Protocol):
    def publish(self, name: str, df: DataFrame) -> DataFrame:
        """Replace the stored dataset and return it as read back."""
        ...


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RELEASE = threading.Lock()
_RELEASING: dict[SparkSession, list] = {}  # how many writes a session is running, and the setting before them


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside delete their shuffle files when they end.

    Else the files stay until the driver happens to collect garbage, so the disk holds those of
    every step at once. Only for rows that are written and read back. Threads may overlap.
    """
    with _RELEASE:
        running = _RELEASING.setdefault(spark, [0, spark.conf.get(SHUFFLES_GO)])
        running[0] += 1
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _RELEASE:
            running[0] -= 1
            if not running[0]:
                spark.conf.set(SHUFFLES_GO, _RELEASING.pop(spark)[1])


class ParquetSink:
    """Parquet datasets under a shared root; each publish is a folder of its own, switched to by one pointer.

    ``root/name/_current`` names the folder that holds the dataset now. It is replaced in one step
    after all rows are written, so a reader, or a run that fails in between, always finds the
    version before; a dataset may even be computed from the version that it replaces. The last
    ``keep`` versions stay, for readers that opened one of them.

    Datasets named in ``bucket_by`` are stored in hash buckets of the given column, one sorted file
    each: joins and groupings of such datasets on it need no shuffle. It should be unique or nearly
    so, as a bucket is read by one task.

    Reading the stored copy back cuts the lineage, so a lost executor costs at
    most the tasks of one stage.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        partition_by: dict[str, list[str]] | None = None,
        bucket_by: dict[str, str] | None = None,
        keep: int = 2,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = partition_by or {}
        self.bucket_by = bucket_by or {}
        self.keep = max(1, keep)

    def publish(self, name: str, df: DataFrame, key: str = "", buckets: int = 0) -> DataFrame:
        """Store ``df`` as the new version of the dataset, or of its variant ``key``, and read it back.

        ``buckets`` says that the rows have been dealt already to so many partitions by the dataset's bucket column.
        """
        before = self.about(name, key)
        version = uuid.uuid4().hex
        path = f"{self._home(name, key)}/{version}"
        counted = Observation()
        rows = df
        if not buckets and name in self.bucket_by:
            buckets = self._buckets()
            rows = df.repartition(buckets, self.bucket_by[name])
        writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(*self.partition_by.get(name, []))
        about = {"version": version, "older": [], "buckets": buckets, "schema": _ddl(df)}
        table = _bucket_table(version)
        try:
            with shuffles_released(self.spark):
                if buckets:
                    writer.bucketBy(buckets, self.bucket_by[name]).sortBy(self.bucket_by[name]).option("path", path).format("parquet").saveAsTable(table)
                else:
                    writer.parquet(path)
            about["rows"] = counted.get["rows"]
        except BaseException:
            if buckets:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove(self.spark, path)
            raise
        older = [before["version"], *before["older"]] if before else []
        about["older"] = older[: self.keep - 1]
        self._switch(name, key, path, about)
        for old in older[self.keep - 1 :]:
            remove(self.spark, f"{self._home(name, key)}/{old}")
        return self._open(name, key, about)

    def about(self, name: str, key: str = "") -> dict | None:
        """What the pointer says of the current version: its folder, row count and schema."""
        text = read_text(self.spark, f"{self._home(name, key)}/_current")
        return json.loads(text) if text else None

    def find(self, name: str, key: str = "") -> DataFrame | None:
        """The current version, if the dataset has been published. Starts no job."""
        about = self.about(name, key)
        return self._open(name, key, about) if about else None

    def note(self, name: str, text: str | None = None) -> str | None:
        """A text kept beside the dataset: written if one is given, else read."""
        path = f"{self.root}/{name}/_note"
        if text is None:
            return read_text(self.spark, path)
        replace_text(self.spark, path, text)
        return text

    def _home(self, name: str, key: str) -> str:
        return f"{self.root}/{name}/{key}" if key else f"{self.root}/{name}"

    def _buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _switch(self, name: str, key: str, path: str, about: dict) -> None:
        replace_text(self.spark, f"{self._home(name, key)}/_current", json.dumps(about))

    def _open(self, name: str, key: str, about: dict) -> DataFrame:
        path = f"{self._home(name, key)}/{about['version']}"
        if not about["buckets"]:
            return self.spark.read.schema(about["schema"]).parquet(path)
        table, column = _bucket_table(about["version"]), self.bucket_by[name]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({about['schema']}) USING parquet"
            f" CLUSTERED BY ({column}) SORTED BY ({column}) INTO {about['buckets']} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(table)


def _bucket_table(version: str) -> str:
    """Only tables of the session catalog know of their buckets."""
    return f"chartloom_buckets_{version}"


def _ddl(df: DataFrame) -> str:
    return df._jdf.schema().toDDL()


class TableSink(ParquetSink):
    """Datasets of the session catalog, under the names that ``table_sources`` reads.

    ``layer.name`` is found as ``name`` of database ``layer``, which is made if it is missing; a
    name without a layer goes to ``database``. The entry is a view of the current version's folder
    below the warehouse, and replacing that view is the switch.
    """

    def __init__(self, spark: SparkSession, database: str = "default", root: str | None = None, keep: int = 2):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        super().__init__(spark, root or f"{warehouse}/chartloom_versions", keep=keep)
        self.database = database

    def _home(self, name: str, key: str) -> str:
        layer, _, plain = name.rpartition(".")
        return super()._home(f"{layer or self.database}/{plain}", key)

    def _switch(self, name: str, key: str, path: str, about: dict) -> None:
        super()._switch(name, key, path, about)
        layer, _, plain = name.rpartition(".")
        layer = layer or self.database
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        self.spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{plain}` AS SELECT * FROM parquet.`{path}`")


class ViewSink:
    """Session-scoped datasets: named views that store nothing."""

    def publish(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name.replace(".", "_"))
        return df


def shared_workspace(spark: SparkSession, bucket_by: dict[str, str] | None = None) -> ParquetSink:
    """A sink in a new subfolder of the folder that the session names in ``spark.checkpoint.dir``.

    The subfolder is removed when this program ends. A cluster must name the folder; only a
    session of one process gets a temporary one, which that process alone reads.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _own_folder()
    path = f"{root.rstrip('/')}/chartloom-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return ParquetSink(spark, path, bucket_by=bucket_by)


_WORKSPACES: dict[str, ParquetSink] = {}


def _workspace(spark: SparkSession) -> ParquetSink:
    application = spark.sparkContext.applicationId
    if application not in _WORKSPACES:
        _WORKSPACES[application] = shared_workspace(spark)
    return _WORKSPACES[application]


def stored(df: DataFrame) -> DataFrame:
    """Rows written once to the session's own workspace and read back, so that nothing computes them again."""
    return _workspace(df.sparkSession).publish(uuid.uuid4().hex, df)


def stored_by(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Like ``stored``, in buckets: rows come dealt by ``repartition(buckets, column)``, and joins on it need no shuffle."""
    workspace, name = _workspace(df.sparkSession), uuid.uuid4().hex
    workspace.bucket_by[name] = column
    return workspace.publish(name, df, buckets=buckets)


def dropped(*frames: DataFrame) -> None:
    """Delete the rows of frames that ``stored`` returned, once no later step reads them."""
    for df in frames:
        mark = f"/{_workspace(df.sparkSession).root.rsplit('/', 1)[-1]}/"
        for path in {f"{before}{mark}{rest.split('/')[0]}" for before, found, rest in (f.partition(mark) for f in df.inputFiles()) if found}:
            remove(df.sparkSession, path)


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="chartloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
