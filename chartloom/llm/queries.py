"""The registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, divergence, exact, jaccard, langid, merkle, nearest, packing, pii, shared, tokens, urls, vectors, warc
from .ship import ship

WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, sql: str | None = None):
    """Register ``build(rows)`` over a whole table."""

    def add(build: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(ship(spark).read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))
        if sql:
            ORACLES[name] = sql
        return build

    return add


@query("op1_embedding_near_dedup", "embeddings")
def op1(rows: DataFrame) -> DataFrame:
    return vectors.near_duplicate_vectors(rows)


@query("op2_ngram_jaccard", "documents")
def op2(docs: DataFrame) -> DataFrame:
    found = jaccard.near_duplicate_groups(docs, width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@query("op3_language_id", "documents")
def op3(docs: DataFrame) -> DataFrame:
    return langid.language_id(docs, public_tokenizers.path(PIECES))


# Base 32 of a hexadecimal text: five digits are 20 bits, which are four letters.
BASE32_SQL = """array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform(range(0, 4),
  lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((CAST('0x' || substr(h, CAST(i * 5 + 1 AS INT), 5) AS BIGINT)) >> CAST(15 - 5 * j AS INT)) & 31)::INT, 1)), '')), '')"""


@query(
    "op4_warc",
    "pages",
    f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, {BASE32_SQL} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM w""",
)
def op4(pages: DataFrame) -> DataFrame:
    return warc.archived_pages(pages, shared.shared_folder(pages.sparkSession))


@query("op5_token_counts", "documents")
def op5(docs: DataFrame) -> DataFrame:
    return tokens.token_counts(docs, public_tokenizers.path(WORD_BPE), limit=2048)


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query("op6_url_filters", "pages")
def op6(pages: DataFrame) -> DataFrame:
    return urls.url_verdicts(pages, URL_RULES)


@query("op7_bpe_round_trip", "documents")
def op7(docs: DataFrame) -> DataFrame:
    return bpe.bpe_round_trip(docs, public_tokenizers.path(WORD_BPE))


@query(
    "op8_exact_dedup",
    "documents",
    r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
)
def op8(docs: DataFrame) -> DataFrame:
    found = exact.exact_duplicates(docs)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op9_best_fit_packing", "documents")
def op9(docs: DataFrame) -> DataFrame:
    return packing.best_fit_packing(packing.token_pieces(docs, public_tokenizers.path(WORD_BPE)))


@query("op10_personal_data", "documents")
def op10(docs: DataFrame) -> DataFrame:
    found = pii.personal_data(docs)
    counts = [F.size(F.filter("base", pii.of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    digest = F.sha2(pii.as_text(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


@query(
    "op11_source_divergence",
    "documents",
    r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
t AS (SELECT c.lang, c.source, sum(c.n) AS total FROM c JOIN k USING (lang, term) GROUP BY c.lang, c.source),
g AS (SELECT DISTINCT lang, source FROM d),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * v.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n + 2)) // (v.total + 2 * v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM e)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM o WHERE part = 'pair' OR rank <= 10""",
)
def op11(docs: DataFrame) -> DataFrame:
    return divergence.source_divergence(docs)


@query("op12_permutation_neighbours", "embeddings")
def op12(vectors: DataFrame) -> DataFrame:
    return nearest.nearest_neighbours(vectors, "vec_id % 100 = 0")


def _unsigned_crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL: a byte's table entry is the sum of those of its bits."""
    bits = []
    for bit in range(8):
        entry = 1 << bit
        for _ in range(8):
            entry = entry >> 1 ^ (0xEDB88320 if entry & 1 else 0)
        bits.append(f"(((xor(a, b) >> {bit}) & 1) * {entry})")
    step = f"(a >> 8)"
    for entry in bits:
        step = f"xor({step}, {entry})"
    start = f"list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT))"
    return f"xor(4294967295::BIGINT, list_reduce({start}, lambda a, b: {step}))"


def _leaf_sql(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE octet_length(encode({f})) || ':' || {f} END" for f in fields) + ")"


def _tree_sql(name: str, start: str, levels: int) -> list[str]:
    """CTEs ``name_0`` .. of (tree, place, nodes, node, lft, rgt): each level of all trees, siblings included."""
    out = []
    for k in range(levels + 1):
        below = f"({start})" if k == 0 else f"""(SELECT tree, place // 3 AS place, (max(nodes) + 2) // 3 AS nodes,
          CASE WHEN max(nodes) > 1 THEN sha256(string_agg(node, '' ORDER BY place)) ELSE max(node) END AS node FROM {name}_{k - 1} GROUP BY tree, place // 3)"""
        out.append(f"""{name}_{k} AS (SELECT *,
          coalesce(string_agg(node, '') OVER (PARTITION BY tree, place // 3 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
          coalesce(string_agg(node, '') OVER (PARTITION BY tree, place // 3 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {below} t)""")
    return out


def _merkle_sql(source_levels: int = 14, root_levels: int = 7) -> str:
    """Trees of up to 3^14 documents a source and 3^7 sources."""
    tree = "CASE WHEN source IS NULL THEN '' ELSE '+' || source END"
    ctes = [f"""leaves AS (SELECT doc_id, {tree} AS tree, {_leaf_sql('text')} AS leaf,
      CASE WHEN {_unsigned_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS other FROM documents)""",
      "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS nodes FROM leaves)"]
    ctes += _tree_sql("s", "SELECT tree, place, nodes, leaf AS node FROM placed", source_levels)
    ctes += _tree_sql("r", f"SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS nodes, node FROM s_{source_levels}", root_levels)
    ctes.append(f"tops AS (SELECT tree AS name, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS spot FROM s_{source_levels})")
    rows, proof, last = "placed p JOIN tops q ON p.tree = q.name", "''", "other"
    ctes.append(f"f0 AS (SELECT doc_id, leaf, subroot, p.tree, place, spot, other AS node, '' AS proof FROM {rows})")
    n = 0
    for name, levels, tree_of, at in (("s", source_levels, "f.tree", "f.place"), ("r", root_levels, "''", "f.spot")):
        for k in range(levels):
            ctes.append(f"""f{n + 1} AS (SELECT f.doc_id, f.leaf, f.subroot, f.tree, f.place, f.spot, f.proof || l.lft || l.rgt AS proof,
              CASE WHEN l.nodes > 1 THEN sha256(l.lft || f.node || l.rgt) ELSE f.node END AS node
              FROM f{n} f JOIN {name}_{k} l ON l.tree = {tree_of} AND l.place = {at} // {3**k})""")
            n += 1
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM f{n} f CROSS JOIN (SELECT node AS root FROM r_{root_levels}) t"""


@query("op13_merkle_manifest", "documents", _merkle_sql())
def op13(docs: DataFrame) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.merkle_manifest(docs, altered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, tampered=even)
