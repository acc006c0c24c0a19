"""Near duplicates by the Jaccard similarity of word shingles, with adaptive multi-match prefixes.

Prefix filter: order all shingles in one way. If two sets overlap enough, then of the first
``n - ceil(t n) + l`` shingles of each at least ``l`` are shared, for every ``l`` (t is the
threshold, n the set's size). Each document picks its own ``l`` by an estimate of what its
candidates will cost; a pair must share the smaller of its two documents' ``l``.

Places prune further. If the k-th shared shingle of a pair stands at places i and j of its sets
(counted from 0), the overlap is at most ``k + min(n_a - i, n_b - j) - 1``. So the first ``l``
shared shingles of a pair that links all meet that bound with k = l, and only those are counted.
In the smaller set of the two they are even *early*: among its first
``n - ceil(2 t n / (1 + t)) + l``. Two documents that both hold a shingle late never meet in it, so
a large group whose members have many shingles of their own before the shared ones makes no pairs.

Every set has a sketch of ``SKETCH`` bits, each the parity of its shingles with that remainder. Bits
in which two sketches differ stand for different shingles that only one set has, so sets link only
if there are at most n_a + n_b - 2 (least overlap) of them. Pairs are dropped by that inside the
join too; it is a bound, so no link is lost.

Rare shingles come first. Counting all of them would move more than the texts themselves, so the
order has three classes, which depend on the shingle alone:

0. shingles whose hash is below ``SHARE`` of the hash space, counted over all documents, and
   found in fewer than ``HOT`` of them: by count, then hash;
1. the other hashes, counted among the documents that do not have enough of class 0: likewise;
2. shingles like class 0 with larger counts.

Any order gives the same result; this one keeps shared passages out of prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .batches import coded, filled, settled, slices, spread, words
from .components import components
from .shared import cut, dropped, sent_if_small, shuffles_released, stored

SHARE = 0.25
HOT = 32
SIZES = (1, 2, 4, 8)  # what l is chosen from
LEAST_ROUNDS, MOST_ROUNDS = 1, 12  # of verification against single documents; more save pairs, none change results
SKETCH = 256
PASS_SHINGLES, PASSES = 1_000_000, 4  # more shingles than these are counted in several passes over ranges of hashes
SLICE_BYTES = 2 << 20  # of text hashed at once; its words and shingles take many times that
BOUND = int(SHARE * 2**64) - 2**63  # hashes are stored as signed numbers, in the same order


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text, one after the other, with offsets."""
    offsets, flat = words(pc.ascii_lower(texts))
    codes, distinct = coded(flat)
    known = pd.util.hash_array(distinct.to_numpy(zero_copy_only=False).astype(object), categorize=False) if len(distinct) else np.zeros(0, np.uint64)
    h = known[codes]
    n_words = np.diff(offsets)
    n = np.where(n_words == 0, 0, np.maximum(n_words - width + 1, 1))
    at = spread(offsets[:-1], n)
    last = np.repeat(offsets[1:], n)
    value = np.repeat(np.minimum(n_words, width), n).astype(np.uint64)  # a short text is no shingle of a longer one
    padded = np.concatenate([h, np.zeros(width, np.uint64)])
    for k in range(width):
        inside = at + k < last
        value = np.where(inside, _mixed(value * np.uint64(0x9E3779B97F4A7C15) + padded[at + k]), value)
    signed = (value ^ np.uint64(1 << 63)).view(np.int64)
    ends = np.concatenate([[0], np.cumsum(n)])
    sets = [np.unique(signed[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate([*sets, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum(sizes)])


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _rows(matrix: np.ndarray) -> pa.Array:
    return _lists(matrix.reshape(-1), np.arange(len(matrix) + 1) * matrix.shape[1])


def sketches(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The parity sketch of each set, as rows of 64-bit numbers."""
    n = len(offsets) - 1
    place = np.repeat(np.arange(n) * SKETCH, np.diff(offsets)) + (values & (SKETCH - 1))
    odd = (np.bincount(place, minlength=n * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, SKETCH), axis=1).view(np.int64)


def set_summaries(docs: DataFrame, width: int) -> DataFrame:
    """id, n (set size), digest and sketch of the set, head (its shingles of the counted share) of rows (id, text)."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                values, offsets = shingle_sets(filled(batch["text"]), width)
                digests = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                low = values < BOUND
                kept = np.concatenate([[0], np.cumsum(low)])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], pa.array(np.diff(offsets)), pa.array(digests, pa.binary()), _rows(sketches(values, offsets)), _lists(values[low], kept)],
                    names=["id", "n", "digest", "sketch", "head"],
                )

    return docs.mapInArrow(settled(summarise), f"id {docs.schema['id'].dataType.simpleString()}, n long, digest binary, sketch array<long>, head array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """id and all shingles of rows (id, text)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                values, offsets = shingle_sets(filled(batch["text"]), width)
                yield pa.RecordBatch.from_arrays([batch["id"], _lists(values, offsets)], names=["id", "shingles"])

    return docs.mapInArrow(settled(sets), f"id {docs.schema['id'].dataType.simpleString()}, shingles array<long>")


def _needed(percent: int) -> Column:
    """Least overlap of a set of n shingles with any set that it may link to."""
    return F.floor((F.col("n") * percent + 99) / 100)


def _least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Least overlap with which sets of these sizes link."""
    return F.floor((percent * (a + b) + 99 + percent) / (100 + percent))


def _with_places(entries: Column, first: Column) -> Column:
    """Entries (count, token) with their places in the document's order, from ``first`` on."""
    return F.transform(entries, lambda e, i: F.struct((first + i).cast("long").alias("place"), e["count"].alias("count"), e["token"].alias("token")))


def _chosen_prefix(percent: int) -> tuple[Column, Column]:
    """The l with the least estimated cost, and the entries of its prefix.

    Every entry of a prefix is scanned with its count - 1 partners, and at most that sum over l
    of them share l entries and are verified, each at a cost that grows with the set.
    """
    base = F.col("n") - _needed(percent)
    costs = []
    for size in SIZES:
        partners = F.aggregate(_within(base + size), F.lit(0).cast("long"), lambda s, e: s + e["count"] - 1)
        cost = F.struct((partners * (1 + F.col("n") / 32.0 / size)).alias("cost"), F.lit(size).cast("long").alias("l"))
        costs.append(F.when(F.lit(size) <= _needed(percent), cost))
    return F.array_min(F.filter(F.array(*costs), lambda c: c.isNotNull()))["l"], base


def _within(size: Column) -> Column:
    return F.filter("entries", lambda e: e["place"] < size)


def shared_shingles(sets: DataFrame) -> DataFrame:
    """(row, token, count) of the counted shingles that several documents hold.

    Hashes are taken in ranges, one after the other, so that the disk holds the shuffles of one
    range at a time and not those of all. Every range covers all documents.
    """
    head = sets.where("n > 0").select("row", "head")
    many = (head.agg(F.sum(F.size("head"))).first()[0] or 0) > PASS_SHINGLES
    least, width = -(2**63), int(SHARE * 2**64)
    edges = [least + width * k // PASSES for k in range(PASSES + 1)] if many else [least, BOUND]
    parts = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        rows = head.select("row", F.explode(F.filter("head", lambda s: (s >= F.lit(low)) & (s < F.lit(high)))).alias("token"))
        counts = rows.groupBy("token").agg(F.count("*").alias("count")).where("count >= 2")
        parts.append(stored(rows.join(counts, "token").select("row", "token", "count")))
    return reduce(DataFrame.union, parts)


def prefixes(sets: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(token, id, n, l, place, early, sketch) of all prefixes, without tokens that only one document has; and the full sets needed.

    ``sets`` has (row, n, head) of all documents; ``nodes`` (row, id, n, n_head, sketch) of one for each
    distinct set; ``texts`` the rows (id, text) to read full sets from. Stored ``sets`` are deleted once they are counted.
    """
    rare = F.col("count") < HOT
    entry = F.struct("count", "token")
    found = shared_shingles(sets)
    shared = found.groupBy("row").agg(
        F.collect_list(F.when(rare, entry)).alias("rare"), F.collect_list(F.when(~rare, entry)).alias("hot"),
        F.count(F.when(rare, 1)).alias("n_rare"), F.count(F.when(~rare, 1)).alias("n_hot"),
    )
    known = nodes.join(shared, "row", "left").drop("row")
    # Sizes are columns of the aggregate, since an array named inside a lambda is built for each element.
    none = F.array().cast("array<struct<count:bigint,token:bigint>>")
    known = known.withColumns({c: F.coalesce(F.col(c), none) for c in ("rare", "hot")} | {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_rare", "n_hot")})
    longest = F.col("n") - _needed(percent) + max(SIZES)
    known = known.withColumn("enough", F.col("n_head") - F.col("n_hot") >= F.least(longest, F.col("n")))
    # shingles of one document come first in class 0, and need no entry
    first = F.col("n_head") - F.col("n_hot") - F.col("n_rare")
    known = known.where(~F.col("enough") | ((F.col("n_rare") > 0) & (first < longest)))
    known = stored(known.withColumn("rare", _with_places(F.sort_array("rare"), first)))
    dropped(found, sets)

    ids = sent_if_small(known.select("id"))
    full = stored(full_sets(texts.join(ids, "id", "left_semi"), width))

    wide = known.where(~F.col("enough")).select("id", "n", "sketch", "n_hot", "rare", "hot")
    others = full.join(wide.select("id"), "id", "left_semi").select("id", F.explode(F.filter("shingles", lambda s: s >= BOUND)).alias("token"))
    other_counts = others.groupBy("token").agg(F.count("*").alias("count")).where("count >= 2")
    more = others.join(other_counts, "token").groupBy("id").agg(F.collect_list(entry).alias("more"), F.count("*").alias("n_more"))
    wide = wide.join(more, "id", "left").withColumns({"more": F.coalesce("more", none), "n_more": F.coalesce("n_more", F.lit(0))})
    mid = _with_places(F.sort_array("more"), F.col("n") - F.col("n_hot") - F.col("n_more"))
    high = _with_places(F.sort_array("hot"), F.col("n") - F.col("n_hot"))
    wide = wide.select("id", "n", "sketch", F.concat("rare", mid, high).alias("entries"))
    every = known.where("enough").select("id", "n", "sketch", F.col("rare").alias("entries")).unionByName(wide)
    best, base = _chosen_prefix(percent)
    # Written before the entries are spread out, or l would be computed again for each of them.
    chosen = every.select("id", "n", "sketch", best.alias("l"), "entries")
    chosen = stored(chosen.select("id", "n", "sketch", "l", _within(base + F.col("l")).alias("entries")))
    dropped(known)
    chosen = chosen.select("id", "n", "sketch", "l", F.explode("entries").alias("entry"))
    early = F.col("entry.place") < F.col("n") - _least_overlap(F.col("n"), F.col("n"), percent) + F.col("l")
    return chosen.select("id", "n", "l", "entry.token", "entry.place", early.alias("early"), "sketch"), full


def verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = full.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = full.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - shared
    return both.where(100 * shared.cast("long") >= percent * union.cast("long")).select("a", "b")


def similar_links(postings: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) with the same components as all pairs of similar sets.

    Prefix tokens are buckets of documents; documents with one label are known to be connected.
    In each round, every document is verified against one document of its buckets' largest label,
    at most one pair per document, and takes over its label if they are similar. Rounds go on
    while the last step would make many more pairs than there are postings and at least a tenth
    of a round's pairs are similar. That last step verifies every
    pair of different labels that shares a bucket, has enough shared tokens at fitting places and
    fitting sizes. In a bucket, pairs are made between the documents outside its largest label and
    all others, unless both hold the token late; so a bucket of one label makes none, nor does one
    without an early document.
    """
    early = F.count(F.when(F.col("early"), 1))
    sizes = postings.groupBy("token").agg(F.count("*").alias("c"), early.alias("e")).where("c >= 2 AND e >= 1").select("token")
    rows = stored(postings.join(sizes, "token").withColumn("label", F.col("id")))
    dropped(postings)
    total = rows.count()
    links, fruitful = None, True
    for turn in range(MOST_ROUNDS):
        parts = rows.groupBy("token", "label").agg(F.count("*").alias("c"), early.alias("e"))
        main = parts.groupBy("token").agg(
            F.max_by(F.struct("label", "c", "e"), F.struct("c", F.xxhash64("label", F.lit(turn)))).alias("main"), F.sum("c").alias("all"), F.sum("e").alias("all_early")
        )
        main = main.select("token", "main.label", "all", "all_early", (F.col("all") - F.col("main.c")).alias("others"), (F.col("all_early") - F.col("main.e")).alias("others_early"))
        main = cut(main.withColumnRenamed("label", "main").where("others > 0"))
        if turn >= LEAST_ROUNDS and (not fruitful or (main.agg(F.sum(F.expr("others_early * all + (others - others_early) * all_early"))).first()[0] or 0) <= 2 * total):
            break
        mixed = rows.join(main.select("token", "main"), "token")
        member = F.struct("id", "label", "n", "l", "place", "early", "sketch")
        # a late member fits no other late document, so an early one is tried first
        inside = mixed.where("label = main").groupBy("token").agg(F.min_by(member, F.struct(~F.col("early"), F.xxhash64("id", F.lit(turn)))).alias("p"))
        near = mixed.where("label <> main").join(inside, "token").where(_may_link(F.col, lambda c: F.col(f"p.{c}"), percent))
        votes = near.groupBy("id", "label", F.struct("p.id", "p.label").alias("p")).agg(F.count("*").alias("shared"))
        best = votes.groupBy("id", "label").agg(F.max_by("p", F.struct("shared", F.xxhash64("p.id"))).alias("p"))
        best = cut(best.select(F.col("id").alias("a"), F.col("p.id").alias("b"), F.col("label").alias("from"), F.col("p.label").alias("to")))
        found = cut(verified(best, full, percent).join(best, ["a", "b"]))
        fruitful = 10 * found.count() >= best.count()
        links = found.select("a", "b") if links is None else links.union(found.select("a", "b"))
        # one step to the label of the partner and one on, so that documents linked to one pivot meet
        onto = found.groupBy("from").agg(F.min("to").alias("to"))
        onward = onto.select(F.col("from").alias("to"), F.col("to").alias("next"))
        onto = onto.join(onward, "to", "left").select(F.col("from").alias("label"), F.coalesce("next", "to").alias("to"))
        # labels only merge, so a bucket of one label is done with
        before, rows = rows, stored(mixed.join(onto, "label", "left").withColumn("label", F.coalesce("to", "label")).select(*rows.columns))
        dropped(before)
    both = rows.join(main.select("token", "main"), "token")
    columns = ("id", "n", "l", "place", "early", "label", "sketch")
    minor = both.where("label <> main").select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    every = both.select("token", "main", *[F.col(c).alias(f"{c}_b") for c in columns])
    apart = F.expr("label_a <> label_b AND (label_b = main OR id_a < id_b)") & _may_link(lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b"), percent)
    # early with all and late with early: late documents of a token are never compared with each other
    pairs = minor.where("early_a").join(every, "token").where(apart).unionByName(minor.where("NOT early_a").join(every.where("early_b"), "token").where(apart))
    enough = F.count("*") >= F.min(F.least("l_a", "l_b"))
    pairs = pairs.groupBy(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).agg(enough.alias("enough")).where("enough")
    links = links.union(cut(verified(pairs, full, percent)))
    dropped(rows, full)
    return links


def _may_link(a, b, percent: int) -> Column:
    """Whether two documents that share a token may link, with it among the first l shared ones."""
    overlap = F.least(a("l"), b("l")) + F.least(a("n") - a("place"), b("n") - b("place")) - 1
    least = _least_overlap(a("n"), b("n"), percent)
    differ = sum((F.bit_count(F.get(a("sketch"), k).bitwiseXOR(F.get(b("sketch"), k))) for k in range(SKETCH // 64)), F.lit(0))
    return _sizes_fit(a("n"), b("n"), percent) & (overlap >= least) & (differ <= a("n") + b("n") - 2 * least)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def near_duplicate_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, class_id, component_id.

    Words are runs of characters other than ASCII white space, with A-Z in lower case. A document's
    set holds its distinct shingles of ``width`` words, or its whole sequence of words if it has
    fewer. Documents link if their sets have a Jaccard similarity of ``percent`` / 100 or more.
    class_id is the smallest id with the same set, component_id the smallest id reachable by links.
    The result is components and not links: documents already known to be connected are not compared
    any more, so the links inside a component of three or more are neither all made nor counted.

    Equal sets are joined by digest first, so copies never meet in pairs. Sets hold 64-bit hashes.
    Null, empty and blank texts have empty sets and link with nothing, not even each other. Ids
    should be unique: rows that repeat one share its component, and of its several texts one is
    searched. A null id is no node of its own; its row gets the class of its set. An empty table gives no rows.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    with shuffles_released(docs.sparkSession):
        sets = stored(set_summaries(rows, width).withColumn("row", F.monotonically_increasing_id()))
        slim = stored(sets.select("id", "n", "digest"))
        able = sets.select("row", "id", "n", "digest", "sketch", F.size("head").alias("n_head")).where("n > 0 AND id IS NOT NULL")
        classes = able.groupBy("digest").agg(F.min(F.struct("id", "row", "n", "n_head", "sketch")).alias("first")).select("digest", "first.*")
        classes = stored(classes.withColumnRenamed("id", "class_id"))
        nodes = classes.groupBy("class_id").agg(F.min_by(F.struct("row", "n", "n_head", "sketch"), "row").alias("first")).select(F.col("class_id").alias("id"), "first.*")
        postings, full = prefixes(sets, nodes, rows, width, percent)
        links = similar_links(postings, full, percent)
        groups = components(links).select(F.col("id").alias("class_id"), "component")
    named = slim.select("id", "n", "digest").join(classes.select("digest", "class_id"), "digest", "left")
    named = named.withColumn("class_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")))
    named = named.join(groups, "class_id", "left")
    return named.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "class_id", F.coalesce("component", "class_id").alias("component_id"))
