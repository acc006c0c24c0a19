"""Names for codes, preferred sources and fallback chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartloom.functions.text import strip_dots
from chartloom.sources.sinks import stored


def lookup(df: DataFrame, dim: DataFrame, on: str | Mapping[str, str], names: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Left join that adds names from a code table.

    ``on`` is a shared column or {left: right}; ``names`` are the columns to add,
    optionally renamed. No broadcast hint: Spark broadcasts the table when its
    size is under the threshold and sort-merges it otherwise.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    added = names if isinstance(names, Mapping) else {n: n for n in names}
    side = dim.select(
        *[F.col(r).alias(f"_on_{l}") for l, r in pairs.items()],
        *[F.col(n).alias(out) for n, out in added.items()],
    )
    condition = None
    for l in pairs:
        part = df[l] == side[f"_on_{l}"]
        condition = part if condition is None else condition & part
    return df.join(side, condition, "left").drop(*[f"_on_{l}" for l in pairs])


def lookup_columns(df: DataFrame, dim: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Name several code columns from one table of (code, value), read and joined once.

    ``columns`` maps a code column to the column to add. All codes of a row are melted to (row,
    position, code), joined, and gathered by row again; a row repeats for every combination of the
    values its codes have, as with one left join per column. Codes that are null never travel. The
    rows are stored first, because their numbers must not change if a task runs again.
    """
    if len(columns) < 2:
        code, value = dim.columns
        return lookup(df, dim, {c: code for c in columns}, {value: n for n in columns.values()}) if columns else df
    dim = dim.toDF("_code", "_value")
    kind = dim.schema["_code"].dataType
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()))
    entries = [F.struct(F.lit(i).alias("_at"), F.col(c).cast(kind).alias("_code")) for i, c in enumerate(columns)]
    melted = rows.select("_row", F.inline(F.array(*entries))).where(F.col("_code").isNotNull())
    hits = melted.join(dim, "_code").groupBy("_row").agg(F.collect_list(F.struct("_at", "_value")).alias("_hits"))
    out = rows.join(hits, "_row", "left")

    def values(at: int) -> Column:
        return F.transform(F.filter("_hits", lambda h: h["_at"] == at), lambda h: h["_value"])

    for i, name in enumerate(columns.values()):
        out = out.withColumn(name, F.explode_outer(values(i)))
    return out.drop("_row", "_hits")


def prefer(primary_ok: Column, primary: Mapping[str, Column], fallback: Mapping[str, Column], name: str) -> Column:
    """All values from one source or all from the other, as a struct."""
    if list(primary) != list(fallback):
        raise ValueError("both sources must offer the same fields in the same order")
    return (
        F.when(primary_ok, F.struct(*[c.alias(n) for n, c in primary.items()]))
        .otherwise(F.struct(*[c.alias(n) for n, c in fallback.items()]))
        .alias(name)
    )


def first_source(dims: Sequence[DataFrame]) -> DataFrame:
    """Union of (code, value) tables where a code counts only in the first table that has it."""
    code, value = dims[0].columns
    result = dims[0].where(F.col(code).isNotNull()).distinct()
    for later in dims[1:]:
        later = later.toDF(code, value).where(F.col(code).isNotNull()).distinct()
        result = result.unionByName(later.join(result.select(code), code, "left_anti"))
    return result


def lookup_chain(df: DataFrame, columns: Mapping[str, str], dims: Sequence[DataFrame], dedupe: bool = False) -> DataFrame:
    """Name each code column from the first table that knows the code.

    ``columns`` maps a code column to the name column to add. The tables are
    merged once, and all code columns are named by one join with them.
    A code with several names in its table yields several rows unless ``dedupe``.
    """
    merged = first_source(dims)
    code, value = merged.columns
    if dedupe:
        merged = merged.groupBy(code).agg(F.min(value).alias(value))
    return lookup_columns(df, merged, columns)


def dotless_codes(codes: DataFrame) -> DataFrame:
    """Distinct code-table rows keyed by the code without dots."""
    return codes.distinct().select(strip_dots(F.col("code")).alias("bare"), "code")


def normalize_codes(
    df: DataFrame, columns: Mapping[str, str], preferred: DataFrame, fallback: DataFrame, dedupe: bool = False
) -> DataFrame:
    """Dotless codes to their dotted spelling, from one code table or else the other.

    ``columns`` maps a raw column to the column to add. The two tables are
    merged by a full join on the bare code, and all raw columns are looked up in
    one join; a row still repeats for every pair of entries, as two outer joins would.
    Extra columns of the tables, such as names, count as separate entries
    unless ``dedupe``.
    """
    second = dotless_codes(fallback).withColumnRenamed("code", "_second")
    merged = dotless_codes(preferred).join(second, "bare", "full")
    merged = merged.select("bare", F.coalesce("code", "_second").alias("code"))
    if dedupe:
        merged = merged.groupBy("bare").agg(F.min("code").alias("code"))
    return lookup_columns(df, merged, columns)


def practice_location(
    people: DataFrame,
    provider: str,
    internal: DataFrame,
    external: DataFrame,
    blank_is_missing: bool,
) -> DataFrame:
    """Add the primary-care location and whether it is internal, external or unknown.

    ``internal`` holds (provider, location), ``external`` one address per
    provider. Without ``blank_is_missing`` a blank external name stays as text.
    """
    inside, outside = F.col("_inside"), F.col("_outside")
    known = F.coalesce(F.nullif(inside, F.lit("")), F.nullif(outside, F.lit("")))
    placed = lookup(people, internal, {provider: internal.columns[0]}, {internal.columns[1]: "_inside"})
    placed = lookup(placed, external, {provider: external.columns[0]}, {external.columns[1]: "_outside"})
    # A provider with a hierarchy entry is internal even when the external address is the one shown.
    kind = F.when(known.isNull(), "Unknown").when(inside.isNotNull(), "Internal").otherwise("External")
    shown = known if blank_is_missing else F.coalesce(inside, outside)
    return placed.select(*people.columns, shown.alias("pcp_location"), kind.alias("pcp_location_type"))
