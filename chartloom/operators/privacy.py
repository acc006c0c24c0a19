"""Datasets with reduced identifiers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from chartloom.operators.surrogates import with_surrogates


def limited_dataset(
    df: DataFrame, crosswalk: DataFrame, key: str, surrogate: str, keep: Sequence[str]
) -> DataFrame:
    """Distinct rows of the allowed columns under a surrogate key; unknown keys are dropped."""
    swap = crosswalk.select(key, F.col(surrogate).alias("_surrogate"))
    return df.join(swap, key).select(F.col("_surrogate").alias(surrogate), *keep).distinct()


def deidentify(
    df: DataFrame,
    crosswalk: DataFrame,
    key: str,
    surrogate: str,
    shift_days: str,
    keep: Sequence[str],
    dates: Iterable[str],
    tokens: Mapping[str, str] | None = None,
    surrogates: DataFrame | None = None,
) -> DataFrame:
    """Limited dataset whose times move by a constant number of days per patient.

    ``tokens`` maps an id column to the name of the number that replaces it, from a crosswalk
    ``surrogates`` of (kind, id, number) whose kinds are the id columns; see ``extend_crosswalk``.
    Nothing in the plan could undo a number. Patients without a number of days have no rows, as
    their dates cannot be moved.
    """
    tokens = dict(tokens or {})
    if tokens and surrogates is None:
        raise ValueError("tokens need a crosswalk of surrogates")
    move = F.make_dt_interval(F.col("_shift"))
    swap = crosswalk.select(key, F.col(surrogate).alias("_surrogate"), F.col(shift_days).cast("int").alias("_shift"))
    joined = df.join(swap.where("_shift IS NOT NULL"), key)
    joined = joined.select("_surrogate", "_shift", *dict.fromkeys([*tokens, *keep]))
    if tokens:
        joined = with_surrogates(joined, surrogates, {c: c for c in tokens}, {c: f"_token_{name}" for c, name in tokens.items()})
    out = [F.col("_surrogate").alias(surrogate), *[F.col(f"_token_{name}").alias(name) for name in tokens.values()]]
    moved = set(dates)
    out += [(F.col(c) + move).alias(c) if c in moved else F.col(c) for c in keep]
    return joined.select(*out).distinct()
