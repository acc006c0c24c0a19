"""Near duplicates of embeddings by cross-polytope hashing with multiprobe buckets."""

from __future__ import annotations

import dataclasses
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .shared import cut, stored

BUCKET_ROWS = 512  # vectors per bucket to aim at
BLOCK_ROWS = 4096  # vectors compared at once; larger buckets are cut into pairs of blocks
BEST = 4  # coordinates of a rotated vector that probes choose from


@dataclasses.dataclass(frozen=True)
class Plan:
    """``functions`` hashes make a bucket; each of ``tables`` tables holds a vector in its own bucket and ``probes`` more."""

    functions: int
    tables: int
    probes: int


# By functions: measured on random pairs of cosine 0.9 in 64 dimensions, one table finds 0.96, 0.76,
# 0.56 and about 0.4 of them, so that all tables together find 0.999 or more.
PLANS = [Plan(1, 3, 4), Plan(2, 6, 8), Plan(3, 9, 12), Plan(4, 14, 24)]
# What one table finds in 64 dimensions, and what is left of it when the dimensions double (measured to 512).
FOUND, DOUBLED = [0.959, 0.763, 0.561, 0.428], [0.97, 0.915, 0.85, 0.77]
MISSED = 0.0005  # share of the pairs that all tables together may miss, for more than 64 dimensions


def plan_for(rows: int, dimension: int) -> Plan:
    """Enough hash functions that a bucket holds about ``BUCKET_ROWS`` of evenly spread vectors.

    A table finds fewer pairs in more dimensions, so wider vectors get more tables.
    """
    functions = math.ceil(math.log(max(rows / BUCKET_ROWS, 1.0)) / math.log(2 * _padded(dimension)))
    at = min(max(functions, 1), len(PLANS)) - 1
    doublings = math.log2(_padded(dimension) / 64)
    if doublings <= 0:
        return PLANS[at]
    found = FOUND[at] * DOUBLED[at] ** doublings
    return dataclasses.replace(PLANS[at], tables=max(PLANS[at].tables, math.ceil(math.log(MISSED) / math.log(1 - found))))


def _padded(dimension: int) -> int:
    return max(2, 1 << (dimension - 1).bit_length())


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, size = x.shape
    step = 1
    while step < size:
        pairs = x.reshape(n, -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return x / math.sqrt(size)


def bucket_codes(x: np.ndarray, plan: Plan, seed: int = 17) -> np.ndarray:
    """Buckets of unit vectors, [vector, table, probe]; the first of a table is the vector's own.

    A hash is the signed coordinate of largest size after three rounds of random signs and a
    Hadamard transform. Probes replace coordinates by the next largest ones, in order of how much
    smaller those are; -1 stands for a missing one. Codes of different tables differ.
    """
    size = _padded(x.shape[1])
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    signs = np.random.default_rng([seed, size]).choice([-1.0, 1.0], (plan.tables, plan.functions, 3, size))
    best = min(size, plan.probes + 1 if plan.functions == 1 else BEST)
    choices = np.array(list(itertools.product(range(best), repeat=plan.functions)))
    out = np.empty((len(x), plan.tables, plan.probes + 1), np.int64)
    for table in range(plan.tables):
        loss = np.zeros((len(x), len(choices)))
        code = np.full((len(x), len(choices)), table, np.int64)
        for f in range(plan.functions):
            y = x
            for s in signs[table, f]:
                y = hadamard(y * s)
            order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :best]
            top = np.take_along_axis(y, order, 1)
            name = order * 2 + (top < 0)
            loss += ((np.abs(top[:, :1]) - np.abs(top)) ** 2)[:, choices[:, f]]
            code = code * (2 * size) + name[:, choices[:, f]]
        pick = np.argsort(loss, axis=1, kind="stable")[:, : plan.probes + 1]
        got = np.take_along_axis(code, pick, 1)
        out[:, table] = -1  # tiny dimensions have fewer choices
        out[:, table, : got.shape[1]] = got
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vector: str) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def _links_in(codes_a: np.ndarray, codes_b: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether pairs that share a bucket, here (table, code), share none before it."""
    own_a, own_b = codes_a[:, :, 0], codes_b[:, :, 0]
    a_in_b = (own_a[:, :, None] == codes_b).any(axis=2)  # a's own bucket is one of b's
    b_in_a = (own_b[:, :, None] == codes_a).any(axis=2)
    earlier = (a_in_b | b_in_a)[:, :table].any(axis=1)
    first = np.minimum(np.where(a_in_b[:, table], own_a[:, table], np.iinfo(np.int64).max), np.where(b_in_a[:, table], own_b[:, table], np.iinfo(np.int64).max))
    return ~earlier & (first == code)


def compare_bucket(
    ids: np.ndarray, x: np.ndarray, codes: np.ndarray, own: np.ndarray, weight: np.ndarray, block: np.ndarray, cross: bool,
    table: int, code: int, least: float,
) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of a bucket: links to others that no earlier bucket finds, and the smallest position it is linked to here.

    ``own`` tells which vectors have the bucket as their own; of each pair one must. With
    ``cross``, only pairs between the two blocks count, else only those inside the one block.
    """
    count = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))
    norm = np.sqrt((x * x).sum(axis=1))
    left, right = [], []
    for start in range(0, len(ids), 1024):
        rows = slice(start, start + 1024)
        near = (x[rows] @ x.T) / (norm[rows, None] * norm[None, :]) >= least
        near &= own[rows, None] | own[None, :]
        near &= (block[rows, None] != block[None, :]) if cross else (block[rows, None] == block[None, :])
        i, j = np.nonzero(near)
        i = i + start
        keep = i < j
        left.append(i[keep])
        right.append(j[keep])
    i, j = np.concatenate(left), np.concatenate(right)
    if len(i):
        for at in range(0, len(i), 200_000):
            a, b = i[at : at + 200_000], j[at : at + 200_000]
            first = _links_in(codes[a], codes[b], table, code)
            np.add.at(count, a[first], weight[b[first]])
            np.add.at(count, b[first], weight[a[first]])
        while True:  # smallest position in each component
            before = root.copy()
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            root = root[root]
            if (root == before).all():
                break
    return count, root


def near_duplicate_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", least: float = 0.9) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors of the same dimension link if their cosine, in double precision, is ``least`` or
    more. Equal vectors are one class with a weight. The classes' vectors go to their buckets,
    where every pair with one of the two at home is compared in blocks. A task returns, for each
    vector, only a count and the smallest vector it is joined to, so pairs are never rows; a pair
    that several buckets share counts in the first one alone.

    Vectors that are null, empty or zero, or have null or non-finite components, have no links and
    are components of their own. Hashing may miss links (recall at cosine 0.9 is 0.999 by design, at any width).
    Ids should be unique; a repeated row counts as one more copy. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).alias("vector"), usable(vector).alias("usable"))
    fine = rows.where("usable").select("id", "vector")
    classes = fine.groupBy("vector").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()}  # a row per dimension
    plans = {d: plan_for(n, d) for d, n in sizes.items()}
    width = max([p.tables * (p.probes + 1) for p in plans.values()], default=1)
    id_kind = rows.schema["id"].dataType.simpleString()
    vector_kind = rows.schema["vector"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch["vector"].offsets.to_numpy())
            for d in np.unique(lengths):
                part = batch.filter(pa.array(lengths == d))
                x = _matrix(part["vector"])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                codes = bucket_codes(x / np.sqrt((x * x).sum(axis=1, keepdims=True)), plans[int(d)])
                flat = codes.reshape(len(x), -1)
                yield pa.RecordBatch.from_arrays(
                    [part["class_id"], part["copies"], part["vector"], pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))],
                    names=["id", "copies", "vector", "codes"],
                )

    coded = stored(classes.select("class_id", "copies", "vector").mapInArrow(hashed, f"id {id_kind}, copies long, vector {vector_kind}, codes array<long>"))
    probes = F.create_map(*[F.lit(v) for d, p in plans.items() for v in (d, p.probes + 1)]) if plans else F.create_map(F.lit(0), F.lit(1))
    spread = coded.select("*", F.size("vector").alias("d"), F.posexplode("codes").alias("at", "code")).where("code >= 0")
    spread = spread.withColumn("per_table", probes[F.col("d")])
    spread = spread.withColumns({"table": F.floor(F.col("at") / F.col("per_table")).cast("int"), "own": F.col("at") % F.col("per_table") == 0})
    big = spread.groupBy("d", "code").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_ROWS).select("d", "code", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    spread = spread.join(big, ["d", "code"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    columns = ["d", "code", "low", "high", "table", "own", "block", "id", "copies", "vector", "codes"]

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        at = int(table["table"][0].as_py())
        code = int(table["code"][0].as_py())
        x = _matrix(table["vector"].combine_chunks())
        x = x / np.abs(x).max(axis=1, keepdims=True)
        codes = table["codes"].combine_chunks().flatten().to_numpy().reshape(len(x), plans[x.shape[1]].tables, -1)
        count, root = compare_bucket(
            np.arange(len(x)), x, codes, table["own"].to_numpy(), table["copies"].to_numpy(), table["block"].to_numpy(),
            table["low"][0].as_py() != table["high"][0].as_py(), at, code, least,
        )
        linked = (count > 0) | (root != np.arange(len(x)))
        ids = table["id"].combine_chunks()
        return pa.table({"id": ids.filter(pa.array(linked)), "n": pa.array(count[linked]), "root": ids.take(pa.array(root[linked]))})

    found = spread.select(*columns).groupBy("d", "code", "low", "high").applyInArrow(compare, f"id {id_kind}, n long, root {id_kind}")
    found = cut(found)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.select("class_id", "copies", "vector").join(counts.withColumnRenamed("id", "class_id"), "class_id", "left")
    named = named.join(groups.withColumnRenamed("id", "class_id"), "class_id", "left")
    named = named.select("vector", F.coalesce("component", "class_id").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = fine.join(named, "vector").select("id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.select(F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
