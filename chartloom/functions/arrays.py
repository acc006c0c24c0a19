"""Ordered array and text roll-ups that keep nulls, for use inside ``agg``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F


def gather(order: Sequence[Column], fields: Mapping[str, Column]) -> Column:
    """Rows of a group as structs with ``fields``, sorted by ``order`` ascending, nulls last.

    One collected array can feed any number of output arrays through ``pluck``,
    so a group's rows cross the shuffle once.
    """
    row = F.struct(*[c.alias(n) for n, c in fields.items()]).alias("row")
    return _rows(F.sort_array(F.array_agg(F.struct(*_keys(order), row))))


def rearrange(rows: Column, order: Sequence[str]) -> Column:
    """Gathered rows sorted again by some of their fields."""
    keyed = F.transform(rows, lambda r: F.struct(*_keys([r[name] for name in order]), r.alias("row")))
    return _rows(F.sort_array(keyed))


def pluck(rows: Column, field: str, where: Callable[[Column], Column] | None = None) -> Column:
    """One field of the gathered rows that qualify, null elements kept; null when none does."""
    kept = rows if where is None else F.filter(rows, where)
    return F.when(F.size(kept) > 0, F.transform(kept, lambda r: r[field]))


def _keys(order: Sequence[Column]) -> list[Column]:
    keys = []
    for i, column in enumerate(order):
        keys += [column.isNull().alias(f"n{i}"), column.alias(f"k{i}")]
    return keys


def _rows(keyed: Column) -> Column:
    return F.transform(keyed, lambda x: x["row"])


def ordered_array(value: Column, order: Sequence[Column], where: Column | None = None) -> Column:
    """Array of ``value`` sorted by ``order`` ascending, nulls last, with null elements kept.

    Null when no row qualifies. Each element travels as a struct because the
    built-in collectors drop nulls.
    """
    item = F.struct(*_keys(order), F.struct(value.alias("v")).alias("row"))
    if where is not None:
        item = F.when(where, item)
    items = F.transform(F.sort_array(F.array_agg(item)), lambda x: x["row"]["v"])
    return F.nullif(items, F.slice(items, 1, 0))


def ordered_text(
    value: Column, order: Sequence[Column], separator: str, where: Column | None = None
) -> Column:
    """Non-null values joined in order; null when there are none."""
    kept = value.isNotNull() if where is None else where & value.isNotNull()
    return F.array_join(ordered_array(value, order, kept), separator)


def distinct_text(value: Column, separator: str, where: Column | None = None) -> Column:
    """Distinct non-null values joined in their own order; null when there are none."""
    values = F.collect_set(value if where is None else F.when(where, value))
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), separator))


def array_text(items: Column) -> Column:
    """Array as ``{a,"b c",NULL}``, quoting elements that would otherwise be ambiguous."""
    return F.when(
        items.isNotNull(),
        F.concat(F.lit("{"), F.array_join(F.transform(items, _element_text), ","), F.lit("}")),
    )


def _element_text(item: Column) -> Column:
    ambiguous = (item == "") | (F.upper(item) == "NULL") | item.rlike(r'[{},"\\\s]')
    escaped = F.regexp_replace(item, r'(["\\])', r"\\$1")
    return (
        F.when(item.isNull(), "NULL")
        .when(ambiguous, F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(item)
    )
