"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartloom.sources.files import remove

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STORED = "chartloom-llm-rows-"  # how folders of intermediate rows are named


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="chartloom-llm-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Small intermediate rows written to the checkpoint folder, so that lost executors lose nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Large intermediate rows as compressed Parquet in the shared folder, read back."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{STORED}{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Delete rows written by ``stored`` that no later step reads; other files that the frames read stay."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith(STORED):
                remove(df.sparkSession, folder)


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Frames made inside delete their shuffle files once they have run.

    Else the files stay until the driver happens to collect garbage, so the disk holds every
    step of a long operator at once. Only for steps that are written and read back.
    """
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def sent_if_small(ids: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``ids`` written once and marked for broadcast if there are at most ``most``; else a join shuffles."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= most else ids
