"""Choosing rows: inclusion and exclusion, code lists, text patterns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from chartloom.functions.text import like_any, mapped


def cohort(
    base: DataFrame,
    key: str | Sequence[str],
    include: Iterable[DataFrame] = (),
    exclude: Iterable[DataFrame] = (),
) -> DataFrame:
    """Rows of ``base`` whose key is in every ``include`` set and in no ``exclude`` set."""
    keys = [key] if isinstance(key, str) else list(key)
    for evidence in include:
        base = base.join(evidence.select(*keys), keys, "left_semi")
    for evidence in exclude:
        base = base.join(evidence.select(*keys), keys, "left_anti")
    return base


def inline_rows(df: DataFrame, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant table in the session of ``df``."""
    return df.sparkSession.createDataFrame(list(rows), schema)


def with_codes(df: DataFrame, column: str, codes: Mapping[str, str] | Iterable[str], label: str | None = None) -> DataFrame:
    """Keep rows whose code is on a fixed list; a mapping also adds its label.

    The list is part of the expression, so the scan can skip on it and no join
    is needed.
    """
    kept = df.where(F.col(column).isin(list(codes)))
    if isinstance(codes, Mapping) and label:
        return kept.withColumn(label, mapped(F.col(column), dict(codes)))
    return kept


def categorize(df: DataFrame, code: str, categories: Mapping[str, Sequence[str]], name: str) -> DataFrame:
    """Add the category whose code list holds the row's code; rows in none are dropped."""
    flat = {c: category for category, codes in categories.items() for c in codes}
    return with_codes(df, code, flat, name)


def matching(df: DataFrame, column: str, include: Iterable[str] = (), exclude: Iterable[str] = ()) -> DataFrame:
    """Rows whose text matches any ``include`` pattern ignoring case, and no ``exclude`` pattern with case.

    A null text never qualifies. The patterns of either kind are one expression, so a text is
    read once for each.
    """
    text, include, exclude = F.col(column), list(include), list(exclude)
    if include:
        df = df.where(like_any(text, include, ignore_case=True))
    if exclude:
        df = df.where(~like_any(text, exclude))
    return df
