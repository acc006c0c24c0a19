"""Volume reports and event metrics."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from chartloom.functions.dates import days_between
from chartloom.sources.catalog import Catalog


def qa_report(datasets: Mapping[str, DataFrame], distinct: str | None = None, distinct_name: str = "distinct_case_count") -> DataFrame:
    """Row count, and optionally distinct keys, of each dataset, in name order.

    All datasets are stacked and counted by one aggregate; one row without weight keeps empty ones.
    """

    def rows(name: str, df: DataFrame) -> DataFrame:
        key = [F.col(distinct).alias("_key")] if distinct else []
        return df.select(F.lit(name).alias("dataset"), F.lit(1).alias("_n"), *key)

    stacked = reduce(DataFrame.union, [rows(name, df) for name, df in datasets.items()])
    names = stacked.sparkSession.createDataFrame([(name,) for name in datasets], "dataset string")
    nothing = [F.lit(None).cast(stacked.schema["_key"].dataType)] if distinct else []
    stacked = stacked.union(names.select("dataset", F.lit(0), *nothing))
    counts = [F.sum("_n").alias("record_count")]
    if distinct:
        counts.append(F.countDistinct("_key").alias(distinct_name))
    return stacked.groupBy("dataset").agg(*counts).orderBy("dataset")


def stored_report(cat: Catalog, datasets: Mapping[str, str], distinct: str | None = None, distinct_name: str = "distinct_case_count") -> DataFrame:
    """The same report over stages that ``cat`` stores; ``datasets`` maps a label to a stage.

    Rows were counted while the datasets were written, so they are not read again; distinct keys
    come from one aggregate over the stored key columns. Datasets are stored one after the other, so
    that the disk holds the shuffles of one of them.
    """
    for stage in datasets.values():
        cat.keep([stage])
    counted = cat.spark.createDataFrame([(label, cat.rows(stage)) for label, stage in datasets.items()], "dataset string, record_count long")
    if not distinct:
        return counted.orderBy("dataset")
    keys = [cat[stage].select(F.lit(label).alias("dataset"), F.col(distinct).alias("_key")) for label, stage in datasets.items()]
    cases = reduce(DataFrame.union, keys).groupBy("dataset").agg(F.countDistinct("_key").alias(distinct_name))
    report = counted.join(cases, "dataset", "left").na.fill(0, [distinct_name])
    return report.orderBy("dataset")


def days_from(anchor: Column, events: Mapping[str, Column]) -> list[Column]:
    """Days from the anchor to each event, as named columns."""
    return [days_between(anchor, event).alias(name) for name, event in events.items()]
