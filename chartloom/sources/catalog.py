"""Logical table names, input contracts and the datasets built on them."""

from __future__ import annotations

import functools
import hashlib
import json
import pathlib
import re
import weakref
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from .files import facts
from .sinks import ParquetSink, Sink, stored

Stage = Callable[["Catalog"], DataFrame]
WRITERS = 4  # stages that are stored at the same time


def conform(df: DataFrame, contract: StructType, table: str) -> DataFrame:
    """The declared columns in declared types.

    Ids and codes arrive as text in some tables and numbers in others, so
    everything declared as text is cast once here. Timestamps carry no zone.
    """
    present = {c.lower(): c for c in df.columns}
    missing = [f.name for f in contract if f.name.lower() not in present]
    if missing:
        raise ValueError(f"{table} lacks {missing}")
    columns = []
    for field in contract:
        column = F.col(present[field.name.lower()])
        found = df.schema[present[field.name.lower()]].dataType
        if found != field.dataType:
            lossless = isinstance(field.dataType, StringType)
            column = column.cast(field.dataType) if lossless else column.try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Catalog:
    """Resolves names to DataFrames: published tables, then sources, then stages.

    A stage that has not been published is composed lazily and kept, so stages
    that share it build on one DataFrame. Stages named in ``shared`` are stored
    in ``workspace``: many others read them, and reading a stored cohort beats
    computing it again in every branch of a plan. A stored cohort is found by a
    fingerprint of what it was made from: the files of its sources with their
    sizes and times, the options, and the code. So it serves again, also in a later
    program over the same workspace, exactly as long as none of these changes.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, Callable[[], DataFrame]] | Callable[[str], DataFrame | None],
        stages: Mapping[str, Stage] | None = None,
        contracts: Mapping[str, str] | None = None,
        options: Mapping[str, object] | None = None,
        shared: Iterable[str] = (),
        workspace: ParquetSink | None = None,
    ):
        self.spark = spark
        self._sources = sources
        self._stages = dict(stages or {})
        self._contracts = dict(contracts or {})
        self._resolved: dict[str, DataFrame] = {}
        self.options = dict(options or {})
        self._shared = set(shared) if workspace is not None else set()
        self._workspace = workspace
        self._stored: set[str] = set()
        self._inputs: dict[str, list[str]] = {}  # names that a stage asked for
        self._asking: list[set[str]] = []
        self._prints: dict[str, str] = {}
        self._facts: dict[str, list] = {}  # of input files, looked up once
        self._sourced: dict[str, DataFrame | None] = {}
        self._once: dict[str, DataFrame] = {}
        self._writing: dict[str, Future[DataFrame]] = {}
        self._pool = ThreadPoolExecutor(WRITERS)  # starts threads when they are needed

    def option(self, name: str, default):
        return self.options.get(name, default)

    def find(self, name: str) -> DataFrame | None:
        if self._asking:
            self._asking[-1].add(name)
        if name not in self._resolved:
            df = self._source(name)
            if df is not None and name in self._contracts:
                df = conform(df, StructType.fromDDL(self._contracts[name]), name)
            if df is not None:
                self._stored.add(name)
            elif name in self._shared and name in self._stages:
                self.keep([name])
                return self._resolved[name]
            elif name in self._stages:
                df = self.compose(name)
            if df is None:
                return None
            self._resolved[name] = df
        return self._resolved[name]

    def compose(self, name: str) -> DataFrame:
        """The stage's own plan, even if its rows have been stored; what it reads may be stored."""
        self._asking.append(set())
        try:
            return self._stages[name](self)
        finally:
            self._inputs[name] = sorted(self._asking.pop())

    def keep(self, names: Iterable[str]) -> None:
        """Have shared stages stored, those that do not need each other at the same time.

        Stages are composed in the given order while the rows of earlier ones are being written; one
        that reads another waits for it.
        """
        mine = []
        for name in names:
            if name not in self._shared or name not in self._stages or self._has_source(name):
                self.find(name)
                continue
            if self._asking:
                self._asking[-1].add(name)
            if name in self._writing:
                mine.append(name)
            elif name not in self._resolved:
                df, key = self._present(name), None
                if df is None:
                    df = self.compose(name)
                    self._prints.pop(name, None)
                    key = self.fingerprint(name)
                    present = self._workspace.find(name, key)
                    df, key = (df, key) if present is None else (present, None)
                if key is None:
                    self._store(name, df)
                else:
                    self._workspace.note(name, json.dumps(self._inputs_below(name)))
                    self._writing[name] = self._pool.submit(inheritable_thread_target(self.spark)(self._workspace.publish), name, df, key)
                    mine.append(name)
        for name in mine:
            if name in self._writing:
                self._store(name, self._writing[name].result())
                del self._writing[name]

    def _store(self, name: str, df: DataFrame) -> None:
        self._resolved[name] = df
        self._stored.add(name)

    def _present(self, name: str) -> DataFrame | None:
        """The rows stored for the present inputs, if there are any."""
        note = self._workspace.note(name)
        if not note or not all(n in self._stages for n in json.loads(note)):
            return None
        self._inputs = json.loads(note) | self._inputs
        return self._workspace.find(name, self.fingerprint(name))

    def _inputs_below(self, name: str) -> dict[str, list[str]]:
        found, todo = {}, [name]
        while todo:
            at = todo.pop()
            if at in self._inputs and at not in found:
                found[at] = self._inputs[at]
                todo += self._inputs[at]
        return found

    def fingerprint(self, name: str) -> str:
        """What decides the rows of a source or stage; equal prints mean equal rows. Starts no job.

        A source that reads no files, such as rows given by the program, counts as the same only
        within its own session.
        """
        if name.startswith("?"):  # a stage asked whether this is stored
            return str(self.is_stored(name[1:]))
        if name not in self._prints:
            df = None if name in self._inputs else self._source(name)
            if df is None and name in self._stages and name not in self._inputs:
                self.find(name)
            if name in self._inputs:
                parts = [name, self.options, code_print(), _own_code(self._stages[name]), [(i, self.fingerprint(i)) for i in self._inputs[name]]]
            elif df is None:
                parts = [name, "absent"]
            else:
                files, text = _reads(df)
                new = [f for f in files if f not in self._facts]
                self._facts.update((f, facts(self.spark, [f])) for f in new)
                parts = [name, self._contracts.get(name), [self._facts[f] for f in files], text]
                if not files:
                    parts += [df.semanticHash(), self.spark.sparkContext.applicationId]
            self._prints[name] = hashlib.sha256(repr(parts).encode()).hexdigest()
        return self._prints[name]

    def rows(self, name: str) -> int | None:
        """Rows of a stage that is stored in the workspace, as counted while they were written."""
        if self.find(name) is None or name not in self._shared:
            return None
        about = self._workspace.about(name, self.fingerprint(name))
        return about["rows"] if about else None

    def once(self, name: str, df: DataFrame) -> DataFrame:
        """Intermediate rows that several stages ask for, stored at the first time and read until the next refresh."""
        if name not in self._once:
            self._once[name] = stored(df)
        return self._once[name]

    def is_stored(self, name: str) -> bool:
        """Whether ``name`` has been read from a source or published, not merely composed."""
        if self._asking:
            self._asking[-1].add(f"?{name}")
        return name in self._stored or self._has_source(name)

    def __getitem__(self, name: str) -> DataFrame:
        df = self.find(name)
        if df is None:
            raise KeyError(f"no source or stage provides {name}")
        return df

    def _has_source(self, name: str) -> bool:
        return self._sources(name) is not None if callable(self._sources) else name in self._sources

    def _source(self, name: str) -> DataFrame | None:
        if callable(self._sources):
            return self._sources(name)  # a table may have been published meanwhile
        if name not in self._sourced:
            make = self._sources.get(name)
            self._sourced[name] = None if make is None else make()
        return self._sourced[name]

    def refresh(self, sink: Sink, names: Iterable[str]) -> dict[str, DataFrame]:
        """Rebuild stages in the given order; later ones read what earlier ones stored.

        Frames composed before are dropped, as they may read files replaced here.
        """
        for name in [n for n in self._resolved if n in self._stages and n not in self._stored]:
            del self._resolved[name]
        self._once.clear()
        done = {}
        for name in names:
            done[name] = self._resolved[name] = sink.publish(name, self.compose(name))
            self._stored.add(name)
        return done


_READS: weakref.WeakKeyDictionary[DataFrame, tuple[list[str], str]] = weakref.WeakKeyDictionary()


def _reads(df: DataFrame) -> tuple[list[str], str]:
    """The files that a frame reads, and its analyzed plan without the numbers that differ between sessions."""
    if df not in _READS:
        spark = df.sparkSession
        before = spark.conf.get("spark.sql.debug.maxToStringFields")
        spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
        try:
            text = re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())
        finally:
            spark.conf.set("spark.sql.debug.maxToStringFields", before)
        _READS[df] = (sorted(df.inputFiles()), text)
    return _READS[df]


@functools.cache
def code_print() -> str:
    """Digest of the code that datasets are made by."""
    package = pathlib.Path(__file__).resolve().parent.parent
    files = sorted(f for part in ("functions", "operators", "plans", "sources") for f in (package / part).glob("*.py"))
    return hashlib.sha256(b"".join(f.read_bytes() for f in files)).hexdigest()


def _own_code(stage: Stage) -> str:
    """Stages may also be defined outside this package."""
    code = getattr(stage, "__code__", None)
    return "" if code is None else repr((code.co_code, code.co_names, [c for c in code.co_consts if isinstance(c, (str, int, float, tuple, type(None)))]))


def table_sources(spark: SparkSession) -> Callable[[str], DataFrame | None]:
    """Sources taken from the session catalog."""

    def read(name: str) -> DataFrame | None:
        return spark.table(name) if spark.catalog.tableExists(name) else None

    return read


def parquet_sources(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, Callable[[], DataFrame]]:
    """Sources stored as ``root/<name>.parquet``."""
    base = root.rstrip("/")
    return {name: (lambda n=name: spark.read.parquet(f"{base}/{n}.parquet")) for name in names}
