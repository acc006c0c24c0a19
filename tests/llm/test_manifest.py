"""The Merkle manifest against trees built level by level in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from chartloom.llm.merkle import BLOCK, merkle_manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, level0 int, place date"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def tree(nodes):
    """Top of a tree and each node's siblings on its way up."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 3 * 3 : place // 3 * 3 + 3]
            paths[i].append((run[: place % 3], run[place % 3 + 1 :]))
        level = [h("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        at = [place // 3 for place in at]
    return level[0], paths


def manifest(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = (own, *tree([leaf(r) for r in own]))
    root, above = tree([trees[s][1] for s in sources]) if sources else (None, [])
    out = []
    for s, upper in zip(sources, above):
        own, subroot, paths = trees[s]
        for row, path in zip(own, paths):
            path = path + upper
            even = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0
            node = leaf({**row, "text": row["text"].replace("\n", "")} if even and row["text"] is not None else row)
            for left, right in path:
                node = h("".join([*left, node, *right]))
            proof = h("".join("".join([*left, *right]) for left, right in path))
            out.append((row["doc_id"], leaf(row), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def checked(df):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle_manifest(df, altered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, tampered=even)
    return sorted([tuple(r) for r in found.collect()], key=str)


def row(i, text, lang="en", source="s", n=1):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": n}


def rows_of(frame, rows):
    return frame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", 3, None) for r in rows], SCHEMA)


def test_trees_of_every_small_size(frame):
    """Sources of 1 to 28 documents, a null source and an empty name among them."""
    rows = [row(100 * k + j, f"a\n{j}" if j % 3 else f"b{j}", source=[None, "", "é", "Z", f"s{k}"][min(k, 4)]) for k in range(28) for j in range(k + 1)]
    assert checked(rows_of(frame, rows)) == manifest(rows)


def test_odd_rows(frame):
    """Null in every column, null and repeated ids, rows repeated whole, long texts."""
    rows = [row(None, None, None, None, None), row(None, None, None, None, None), row(1, "x", n=None), row(1, "y\n", None), row(1, "x", n=None)]
    rows += [row(2, ""), row(3, "é\n" * 200_000, "fr", "t"), row(-5, "ü"), row(4, "-", "-", "-")]
    assert checked(rows_of(frame, rows)) == manifest(rows)


@pytest.mark.parametrize("n", [0, 1, BLOCK, 2 * BLOCK + 5])
def test_blocks_of_one_source(frame, n):
    rows = [row(7 * i % 9973, f"t\n{i}") for i in range(n)]
    assert checked(rows_of(frame, rows)) == manifest(rows)


def test_more_sources_than_a_block(frame):
    rows = [row(i, f"t{i}", source=f"{i % (BLOCK + 3)}") for i in range(BLOCK + 40)]
    assert checked(rows_of(frame, rows)) == manifest(rows)


def test_a_changed_document_is_found(frame):
    found = merkle_manifest(rows_of(frame, [row(i, f"a\nb{i}") for i in range(40)]), altered={"text": F.upper("text")}, tampered=F.col("doc_id") < 10)
    assert {r["doc_id"] for r in found.where("NOT verified").collect()} == set(range(10))
