"""Merkle manifest of a table: a tree of digests per source, one over the sources, and each row's proof.

A level of the tree is a string: the hexadecimal digests of an aligned block of 729 nodes, one
after the other. Fixed-width substrings of it are what the next level hashes, and the substrings
to both sides of a node are its siblings. Six levels turn a block into one digest, which is a node
of the next round; rounds go on until every source has one node, and the sources' digests then
pass through the same rounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from chartloom.operators.skew import ranked

from .shared import cut, stored

HEX = 64  # characters of a digest
ARITY = 3
LEVELS = 6
BLOCK = ARITY**LEVELS  # nodes; a level string of a block has at most 46,656 characters

EDGE = "struct<left: binary, right: binary>"  # the siblings of a node on one level


def digest_of(fields: Sequence[Column | str]) -> Column:
    """SHA-256, in lowercase hexadecimal, of the fields: ``-`` for null, else bytes in UTF-8, ``:``, value."""
    parts = []
    for field in fields:
        text = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _runs(count: Column) -> Column:
    """Runs of up to three among ``count`` nodes."""
    return F.floor((count + (ARITY - 1)) / ARITY).cast("int")


def _next_level(level: Column) -> Column:
    """The level above: digests of each run's substring, concatenated."""
    runs = _runs(F.octet_length(level) / HEX)
    digests = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substring(level, i * (ARITY * HEX) + 1, F.lit(ARITY * HEX)), 256))
    return F.array_join(digests, "").cast("binary")


def _depth(nodes: Column) -> Column:
    """Levels that a block of a tree with ``nodes`` nodes goes up: to the one digest left, or all six if there are more blocks."""
    return reduce(lambda rest, k: F.when(nodes <= ARITY**k, F.lit(k)).otherwise(rest), range(LEVELS - 1, -1, -1), F.lit(LEVELS))


def _edges(levels: Column, depth: Column, place: Column) -> Column:
    """Siblings of the node at ``place`` of the block, level by level."""

    def edge(k: Column) -> Column:
        level = F.element_at(levels, k + 1)
        at = F.floor(place / F.element_at(F.array(*[F.lit(ARITY**i) for i in range(LEVELS + 1)]), k + 1)).cast("int")
        start, within = F.floor(at / ARITY).cast("int") * (ARITY * HEX), at % ARITY
        left = F.substring(level, start + 1, within * HEX)
        right = F.substring(level, start + (within + 1) * HEX + 1, (ARITY - 1 - within) * HEX)
        return F.struct(left.alias("left"), right.alias("right"))

    some = F.transform(F.sequence(F.lit(0), depth - 1), edge)
    return F.when(depth > 0, some).otherwise(F.array().cast(f"array<{EDGE}>"))


def fold(node: Column, edges: Column) -> Column:
    """The digest at the top of a path: each level hashes the siblings around the digest so far."""
    return F.aggregate(edges, node, lambda acc, e: F.sha2(F.concat(e["left"], acc.cast("binary"), e["right"]), 256))


def proof_of(edges: Column) -> Column:
    """Digest of all siblings of a path in their order."""
    joined = F.aggregate(edges, F.lit(b""), lambda acc, e: F.concat(acc, e["left"], e["right"]))
    return F.sha2(joined, 256)


def _blocks(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """One row per tree and block: its members in order, its level strings and its top digest.

    ``nodes`` has tree, place (from 0, gapless), nodes (of the tree) and node. A block gathers 729
    rows at most, whatever the size of its tree.
    """
    member = F.struct("place", "node", *payload)
    block = F.floor(F.col("place") / BLOCK).cast("long")
    rows = nodes.groupBy("tree", block.alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"), F.first("nodes").alias("nodes"))
    rows = rows.withColumn("depth", _depth(F.col("nodes")))
    rows = rows.withColumn("level0", F.array_join(F.col("members.node"), "").cast("binary"))
    for k in range(1, LEVELS + 1):
        above = F.when(F.col("depth") >= k, _next_level(F.col(f"level{k - 1}"))).otherwise(F.col(f"level{k - 1}"))
        rows = rows.withColumn(f"level{k}", above)
    levels = F.array(*[F.col(f"level{k}") for k in range(LEVELS)])
    return rows.select("tree", "block", "nodes", "depth", "members", levels.alias("levels"), F.col(f"level{LEVELS}").cast("string").alias("top"))


def _next_nodes(blocks: DataFrame) -> DataFrame:
    return blocks.select("tree", F.col("block").alias("place"), F.ceil(F.col("nodes") / BLOCK).cast("long").alias("nodes"), F.col("top").alias("node"))


def _paths(nodes: DataFrame, most: int) -> DataFrame:
    """(tree, place, top, edges) of every node of small trees: its siblings up to the tree's one digest.

    ``most`` is the size of the largest tree. Rounds recurse: a block's own path is joined to the
    paths of its members.
    """
    blocks = stored(_blocks(nodes))
    here = blocks.select("tree", "block", "depth", "levels", F.posexplode("members").alias("at", "member"), "top")
    here = here.select("tree", F.col("member.place").alias("place"), "block", "top", _edges(F.col("levels"), F.col("depth"), F.col("at")).alias("edges"))
    if most <= BLOCK:
        return here.select("tree", "place", "top", "edges")
    above = _paths(_next_nodes(blocks), -(-most // BLOCK))
    above = above.select(F.col("tree").alias("_tree"), F.col("place").alias("block"), F.col("top").alias("_top"), F.col("edges").alias("_edges"))
    joined = here.join(above, (here["tree"] == above["_tree"]) & (here["block"] == above["block"]))
    return joined.select("tree", "place", F.col("_top").alias("top"), F.concat("edges", "_edges").alias("edges"))


def placed(rows: DataFrame, tree: str, order: str, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``place``, from 0 within the tree by ``order`` (null first), and ``nodes``, the tree's size.

    Places come from one distributed sort, so a tree may hold any share of the rows.
    """
    numbered = ranked(rows, [tree], F.struct(F.col(order).isNotNull(), F.col(order)), [F.col(t).asc_nulls_first() for t in ties], name="place", kind="long")
    numbered = numbered.withColumn("place", F.col("place") - 1)
    sizes = numbered.groupBy(F.col(tree).alias("_tree")).agg(F.count(F.lit(1)).alias("nodes"))
    return numbered.join(sizes, F.col(tree) == F.col("_tree")).drop("_tree")


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id: str = "doc_id",
    source: str = "source",
    altered: Mapping[str, Column] | None = None,
    tampered: Column | None = None,
) -> DataFrame:
    """One row per document: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of the row's ``fields``. Leaves of a source ascend by id; every three
    consecutive nodes become one until one is left, the subroot; subroots, ordered by source with
    null first, become the root in the same way. ``proof_sha256`` is the digest of a row's siblings
    from its leaf to the root. ``folded_root`` is computed from a leaf and these siblings; where
    ``tampered`` holds, that leaf is made of the row with ``altered`` columns in place of its own.

    Null and empty fields differ. Null ids come first, repeated ids follow their leaves, and equal
    rows take neighbouring places. An empty table gives no rows; one row is its own root, with the
    digest of an empty text as its proof. Other columns are ignored, whatever their names.
    """
    altered = altered or {}
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    other = digest_of([altered.get(f, F.col(f)) for f in fields])
    tree = F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))
    leaves = docs.select(F.col(id).alias("id"), tree.alias("tree"), digest_of(fields).alias("node"), F.when(tampered, other).alias("tampered"))
    blocks = stored(_blocks(placed(stored(leaves), "tree", "id", ["node"]), ["id", "tampered"]))

    # The blocks' own digests, up to the sources' digests and on to the root.
    most = blocks.agg(F.max("nodes")).first()[0] or 0
    upper = stored(_paths(_next_nodes(blocks), -(-most // BLOCK)))
    sources = cut(upper.where("place = 0").select(F.lit("").alias("all"), "tree", F.col("top").alias("node")))
    roots = placed(sources, "all", "tree").select(F.col("all").alias("tree"), "place", "nodes", "node", F.col("tree").alias("of"))
    roots = cut(roots)
    above = _paths(roots.drop("of"), roots.count())
    above = roots.select("of", "place").join(above.select("place", "top", F.col("edges").alias("_edges")), "place")
    whole = upper.join(above.select(F.col("of").alias("tree"), F.col("top").alias("root"), "_edges"), "tree")
    whole = whole.select(F.col("tree").alias("_tree"), F.col("place").alias("_block"), F.col("top").alias("subroot"), "root", F.concat("edges", "_edges").alias("_above"))

    rows = blocks.join(whole, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block")))
    rows = rows.select("subroot", "root", "_above", "levels", "depth", F.posexplode("members").alias("at", "member"))
    rows = rows.withColumn("edges", F.concat(_edges(F.col("levels"), F.col("depth"), F.col("at")), F.col("_above")))
    rows = rows.select(
        F.col("member.id").alias(id),
        F.col("member.node").alias("leaf"),
        "subroot",
        "root",
        proof_of(F.col("edges")).alias("proof_sha256"),
        fold(F.coalesce("member.tampered", "member.node"), F.col("edges")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
