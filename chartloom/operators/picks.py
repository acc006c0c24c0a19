"""Ordering, ranking and first-row picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import ranked


def up(column: str | Column) -> Column:
    """Ascending, nulls last."""
    return (F.col(column) if isinstance(column, str) else column).asc_nulls_last()


def down(column: str | Column) -> Column:
    """Descending, nulls first."""
    return (F.col(column) if isinstance(column, str) else column).desc_nulls_first()


def first_per(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """First ``n`` rows per key; ``rank`` keeps the position as a column.

    The filter on the row number lets Spark trim every key to ``n`` rows before
    the shuffle, so hot keys cost no more than others.
    """
    position = rank or "_position"
    window = Window.partitionBy(*keys).orderBy(*order)
    picked = df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= n)
    return picked if rank else picked.drop(position)


def rank_all(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    ties: Sequence[str] = (),
    newest_first: bool = False,
    name: str = "rank",
) -> DataFrame:
    """Number all rows of a key by ``by``; ``ties`` settle equal values."""
    return ranked(df, keys, by, [*map(up, ties)], newest_first, name)


def spread_top(
    df: DataFrame, keys: Sequence[str], rank: str, columns: dict[str, str], n: int
) -> DataFrame:
    """Rows ranked 1..n to columns: ``columns`` maps a source to a name pattern with ``{n}``."""
    wanted = [
        F.max(F.when(F.col(rank) == i, F.col(source))).alias(pattern.format(n=i))
        for i in range(1, n + 1)
        for source, pattern in columns.items()
    ]
    return df.where(F.col(rank) <= n).groupBy(*keys).agg(*wanted)
