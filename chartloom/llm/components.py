"""Connected components of a link table, with every step a shuffle on node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node of ``links``; component is the smallest id reachable.

    Alternates two star operations: each node hands the smallest of its neighbours to its larger
    neighbours, then to its smaller ones, until each node is linked to its component's smallest
    node alone. The number of rounds grows with the logarithm of the longest path. Minima are
    combined in the tasks first; joins on a node with very many links can be split. Null ends,
    repeated links and links of a node to itself are ignored.
    """
    ends = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a).isNotNull() & F.col(b).isNotNull())
    rows = cut(ends.where(ends[2]).select("hi", "lo").where("hi <> lo").distinct())
    before = _mark(rows)
    while before[0]:
        both = rows.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(rows.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        passed = large.join(lowest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        rows = cut(passed.union(lowest.select("hi", F.col("m").alias("lo"))).distinct())
        after = _mark(rows)
        if after == before:
            break
        before = after
    return rows.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(rows.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())


def _mark(rows: DataFrame) -> tuple:
    """Count and order-free checksum of the links, to see whether a round changed any."""
    return tuple(rows.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
