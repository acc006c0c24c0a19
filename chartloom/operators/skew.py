"""Rankings that stay balanced when one key, or one value of it, holds a large share of all rows.

Plain equi joins need nothing here: adaptive execution splits an oversized join
partition, and a single hot key with it, from the sizes seen at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartloom.sources.sinks import stored

_PART_BITS = 33  # monotonically_increasing_id: the task above these bits, the row within it below


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    by: str | Column,
    ties: Sequence[Column] = (),
    newest_first: bool = False,
    name: str = "rank",
    kind: str = "int",
    without: Sequence[str] = (),
) -> DataFrame:
    """Number every row within its keys by ``by``, then by ``ties``; columns ``without`` are not kept.

    Ascending order has nulls last, ``newest_first`` has them first; null keys
    are a group like any other. Rows that are equal in all of these follow a hash
    of the whole row, so the numbers do not depend on the run.

    All rows are sorted once by a range exchange whose bounds may fall anywhere,
    also inside one key and value, and stored. The number of a row is its place in
    its partition, less the place where its key begins there, plus the rows of the
    key in earlier partitions. These last two come from one row per key and
    partition, so no task ever holds a whole key.
    """
    value = F.col(by) if isinstance(by, str) else by
    leading = value.desc_nulls_first() if newest_first else value.asc_nulls_last()
    hashed = [c for c, kind_of in df.dtypes if "map<" not in kind_of and "variant" not in kind_of]
    marked = df.withColumns({"_spread": F.xxhash64(*hashed), "_row": F.monotonically_increasing_id()})
    order = [*[F.col(k).asc_nulls_first() for k in keys], leading, *ties, F.col("_spread"), F.col("_row")]
    placed = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("_spread", "_row", *without)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()))

    part = F.shiftright("_at", _PART_BITS)
    groups = [f"_k{i}" for i in range(len(keys))]
    runs = placed.groupBy(part.alias("_p"), *[F.col(k).alias(g) for k, g in zip(keys, groups, strict=True)])
    runs = runs.agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_p", *groups, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_start") + 1).alias("_move"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(g)) for k, g in zip(keys, groups, strict=True)], part == F.col("_p"))
    return placed.join(runs, same).select(*[c for c in df.columns if c not in without], (F.col("_at") + F.col("_move")).cast(kind).alias(name))
