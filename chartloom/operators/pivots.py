"""Long tables to columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartloom.functions.text import NUMBER


def pivot_first(
    df: DataFrame, keys: Sequence[str], event: str, moment: str, columns: Mapping[str, str]
) -> DataFrame:
    """Earliest time of each named event per key, one row per key."""
    return df.groupBy(*keys).agg(
        *[F.min(F.when(F.col(event) == name, F.col(moment))).alias(out) for name, out in columns.items()]
    )


def _pivoted(df: DataFrame, keys: Sequence[str], item: Column, out: Mapping[str, tuple[Column, Sequence[str], object]]) -> DataFrame:
    """One row per key; each output is (aggregate, items it is made of, value if the key has none of them).

    The items that a key has are gathered as a set, no larger than the list of items. That also lets
    Spark aggregate by hash, in the tasks first: a maximum of texts alone would make it sort all rows.
    """
    found = df.groupBy(*keys).agg(F.collect_set(item).alias("_found"), *[total.alias(name) for name, (total, _, _) in out.items()])

    def value(name: str, items: Sequence[str], missing: object) -> Column:
        some = F.arrays_overlap("_found", F.array(*[F.lit(i) for i in items]))
        return F.when(some, F.col(name)).otherwise(F.lit(missing)).cast(found.schema[name].dataType).alias(name)

    return found.select(*keys, *[value(name, items, missing) for name, (_, items, missing) in out.items()])


def elements_pivot(
    df: DataFrame,
    keys: Sequence[str],
    element: str,
    value: str,
    columns: Mapping[str, str | Sequence[str]],
    cast: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Key/value rows to columns: output name to element name(s); the largest value wins.

    Keys without any wanted element keep a row.
    """
    cast = cast or {}
    out = {}
    for name, wanted in columns.items():
        names = [wanted] if isinstance(wanted, str) else list(wanted)
        read = cast.get(name, lambda c: c)
        out[name] = (F.max(F.when(F.col(element).isin(names), read(F.col(value)))), names, None)
    every = [e for _, names, _ in out.values() for e in names]
    return _pivoted(df, keys, F.when(F.col(element).isin(every), F.col(element)), out)


def conditional_totals(
    df: DataFrame, keys: Sequence[str], item: str, amount: Column, unit: str, items: Mapping[str, str]
) -> DataFrame:
    """Total amount and unit of each item per key; ``items`` maps an item to a column stem."""
    out = {}
    for code, stem in items.items():
        hit = F.col(item) == code
        out[f"{stem}_total_dose"] = (F.sum(F.when(hit, amount).otherwise(0)).cast(NUMBER), [code], 0)
        out[f"{stem}_dose_unit"] = (F.max(F.when(hit, F.col(unit))), [code], None)
    return _pivoted(df, keys, F.when(F.col(item).isin([*items]), F.col(item)), out)
