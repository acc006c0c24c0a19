"""Registration of dataset-building functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from chartloom.operators.picks import down, first_per, rank_all, up
from chartloom.sources.catalog import Catalog, Stage


@dataclass(frozen=True)
class Ranking:
    """Rows of a stage that numbers them, and how."""

    rows: Stage
    keys: Sequence[str]
    by: str
    ties: Sequence[str]
    newest_first: bool
    name: str

    def all(self, cat: Catalog) -> DataFrame:
        return rank_all(self.rows(cat), self.keys, self.by, self.ties, self.newest_first, self.name)

    def first(self, cat: Catalog) -> DataFrame:
        order = [down(self.by) if self.newest_first else up(self.by), *map(up, self.ties)]
        return first_per(self.rows(cat), self.keys, order, rank=self.name)


class Stages(dict):
    """Ordered stage registry: ``@stages("layer.name")`` adds a function."""

    def __init__(self):
        super().__init__()
        self._rankings: dict[str, Ranking] = {}

    def __call__(self, name: str):
        def add(build: Stage) -> Stage:
            self[name] = build
            return build

        return add

    def ranked(
        self,
        name: str,
        by: str,
        ties: Sequence[str] = (),
        newest_first: bool = False,
        keys: Sequence[str] = ("pat_id",),
        rank: str = "rank",
    ):
        """Add a stage that returns the function's rows numbered per key."""

        def add(rows: Stage) -> Stage:
            ranking = Ranking(rows, keys, by, ties, newest_first, rank)
            self._rankings[name] = ranking
            self[name] = ranking.all
            return rows

        return add

    def first(self, cat: Catalog, name: str) -> DataFrame:
        """The rows numbered 1.

        A published stage is filtered; otherwise only the first rows are ever
        numbered, so the full ranking is not computed for them.
        """
        ranking = self._rankings[name]
        if cat.is_stored(name):
            return cat[name].where(F.col(ranking.name) == 1)
        return ranking.first(cat)
