"""Rows that carry several keys of the same kind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unpivot_keys(
    df: DataFrame,
    labels: Mapping[str, Column],
    key: str,
    label: str,
    keep: Sequence[str],
) -> DataFrame:
    """One distinct row per non-null key and its label, from a single scan."""
    pairs = F.array(*[F.struct(F.lit(text).alias(label), column.alias(key)) for text, column in labels.items()])
    return (
        df.select(*keep, F.explode(pairs).alias("_pair"))
        .select(*keep, f"_pair.{key}", f"_pair.{label}")
        .where(F.col(key).isNotNull())
        .distinct()
    )


def join_any_key(left: DataFrame, keys: Sequence[str], right: DataFrame, key: str) -> DataFrame:
    """Inner join where the right key equals any of several left keys.

    Repeated keys in a row count once, as with ``IN``. The list becomes rows, so
    the join hashes on one key instead of comparing every pair.
    """
    candidates = F.array_compact(F.array_distinct(F.array(*keys)))
    return left.withColumn(key, F.explode(candidates)).join(right, key)
