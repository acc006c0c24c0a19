"""Shared pieces of the registered queries."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartloom.functions.arrays import array_text
from chartloom.session import tune
from chartloom.sources.catalog import Catalog
from chartloom.sources.files import facts
from chartloom.sources.sinks import shared_workspace

from .roles import TABLES, compose, cte_names

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_SCHEMAS: dict = {}  # read from each table once while its files stay the same, so that later reads start no job


class Tables:
    """The driver's tables by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._states: dict[str, tuple] = {}

    def state(self, name: str) -> tuple:
        """Path, sizes and times of a table's files, looked up once per query."""
        if name not in self._states:
            path = f"{self.folder}/{name}.parquet"
            self._states[name] = (path, *facts(self.spark, [path]))
        return self._states[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        known = self.state(name)
        path = known[0]
        if known not in _SCHEMAS:
            _SCHEMAS[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[known]).parquet(path)


def check(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name`` with its oracle."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = lambda spark, folder: build(Tables(tune(spark), folder))
        if sql:
            ORACLES[name] = sql
        return build

    return add


_ROLES: dict = {}


def role_frame(tables: Tables, sql: str) -> DataFrame:
    """A role text over the driver's tables; made once while these stay the same."""
    used = sorted({w for w in re.findall(r"[a-z_]+", sql) if w in TABLES})
    key = (tables.spark.sparkContext.applicationId, sql, *(tables.state(name) for name in used))
    if key not in _ROLES:
        for name in used:
            getattr(tables, name).createOrReplaceTempView(name)
        _ROLES[key] = tables.spark.sql(sql)
    return _ROLES[key]


_WORKSPACES: dict = {}


def role_catalog(tables: Tables, roles, stages, contracts, shared=(), bucket_by=None, **options) -> Catalog:
    """A catalog of a group of datasets; all catalogs of a session keep their cohorts in one workspace.

    Queries therefore read the same stored cohorts, as the published scripts do, as long as the
    tables behind them stay the same; a query composes its own stage anew.
    """
    application = tables.spark.sparkContext.applicationId
    if application not in _WORKSPACES:
        _WORKSPACES[application] = shared_workspace(tables.spark, {})
    workspace = _WORKSPACES[application]
    workspace.bucket_by.update(bucket_by or {})
    sources = {name: (lambda text=sql: role_frame(tables, text)) for name, sql in roles.items()}
    return Catalog(tables.spark, sources, stages, contracts, options, shared, workspace)


def arrays_as_text(df: DataFrame) -> DataFrame:
    """Arrays rendered as text, so that any engine compares them alike."""
    kinds = dict(df.dtypes)
    return df.select(*[array_text(F.col(c)).alias(c) if kinds[c].startswith("array") else c for c in df.columns])


def register_datasets(roles, stages, contracts, sql: dict[str, str], names: dict[str, str], shared=(), **options) -> None:
    """One query per stage: ``names`` maps a query name to a stage, ``sql`` holds stage texts by CTE name."""
    known = {**cte_names(roles), **sql}

    def add(query: str, stage: str) -> None:
        cte = stage.replace(".", "__")

        @check(query, compose(f"SELECT * FROM {cte}", known) if cte in sql else None)
        def build(tables: Tables) -> DataFrame:
            return arrays_as_text(role_catalog(tables, roles, stages, contracts, shared, **options).compose(stage))

    for query, stage in names.items():
        add(query, stage)
