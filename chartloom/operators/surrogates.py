"""Numbers that stand for ids, kept from one refresh to the next."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from chartloom.operators.lookups import lookup_columns
from chartloom.operators.skew import ranked
from chartloom.sources.sinks import dropped, stored


def distinct_ids(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """(kind, id) of every id in the columns that ``kinds`` maps to a kind; null ids are left out."""
    pairs = [F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("id")) for column, kind in kinds.items()]
    return df.select(F.inline(F.array(*pairs))).where("id IS NOT NULL").distinct()


def extend_crosswalk(known: DataFrame | None, ids: DataFrame, order: Callable[[Column], Column] | None = None) -> DataFrame:
    """(kind, id, number): ids of an earlier crosswalk keep their numbers, new ones get the next free numbers of their kind.

    New ids are numbered in random order, unless ``order`` gives another, so that a number says
    nothing of its id; no secret is needed, and whoever lacks the crosswalk cannot undo it. The
    numbering is one distributed sort of the new ids. A drawn order is stored, as drawing again would
    change it; a given one is computed from the stored ids, and neither is kept with the numbers.
    """
    new = ids if known is None else ids.join(known.select("kind", "id"), ["kind", "id"], "left_anti")
    drawn = stored(new.withColumn("_order", F.rand()) if order is None else new)
    ordered = drawn if order is None else drawn.withColumn("_order", order(F.col("id")))
    numbered = ranked(ordered, ["kind"], "_order", name="number", kind="long", without=["_order"])
    dropped(drawn)  # the ranking has stored them in order
    if known is None:
        return numbered
    last = known.groupBy("kind").agg(F.max("number").alias("_last"))  # a row per kind
    numbered = numbered.join(F.broadcast(last), "kind", "left")
    numbered = numbered.select("kind", "id", (F.col("number") + F.coalesce("_last", F.lit(0))).alias("number"))
    return known.select("kind", "id", "number").unionByName(numbered)


def with_surrogates(df: DataFrame, crosswalk: DataFrame, kinds: Mapping[str, str], names: Mapping[str, str]) -> DataFrame:
    """Add the numbers of id columns: ``kinds`` maps a column to its kind, ``names`` to the column to add.

    All columns take one join with the crosswalk; null and unknown ids have no number.
    """
    codes = {column: f"_code_{i}" for i, column in enumerate(kinds)}
    coded = df.withColumns({codes[c]: F.concat(F.lit(f"{kind}|"), F.col(c).cast("string")) for c, kind in kinds.items()})
    dim = crosswalk.select(F.concat("kind", F.lit("|"), "id"), "number")
    return lookup_columns(coded, dim, {codes[c]: names[c] for c in kinds}).drop(*codes.values())
