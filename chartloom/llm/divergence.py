"""How far the words of each source are from those of the other sources of its language.

Terms are counted packed: one of up to 8 bytes is a uint64, one of up to 16 is two, in big-endian
order with zero bytes behind, and longer ones stay bytes in buckets of their length. Packed terms
are brought into order by radix passes over 16 bits, byte strings by sorting a bucket; equal
neighbours are then counted as runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .batches import SLICE_BYTES, filled, slices, spread
from .shared import cut, stored

SCALE = 1_000_000_000  # of probabilities
CELLS = 1 << 20  # numbers of a matrix of sources and terms that is compared at once
GROUP_ROWS = 500_000  # counts of a language that one task compares, about
SOURCES = 256  # sources of a language in a block of the comparison

# Bytes of a term: letters, in lower case, and all of a character beyond ASCII; zero for any other byte.
LOWER = np.array([b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0 for b in range(256)], np.uint8)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in lower case, and start, length and row of each term of the texts, in order."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low = LOWER[np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]] if len(texts) and data else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    word = low != 0
    first, after = word.copy(), np.zeros(len(word) + 1, bool)
    first[1:] &= ~word[:-1]
    edges = ends[(ends > 0) & (ends < len(word))]  # a term does not go on in the next text
    first[edges] = word[edges]
    after[:-1] = first | ~word
    after[-1] = True
    starts = np.nonzero(first)[0]
    stops = np.nonzero(after)[0]
    lengths = stops[np.searchsorted(stops, starts, side="right")] - starts
    return low, starts, lengths, np.searchsorted(ends, starts, side="right") - 1


def packed(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each start as a big-endian uint64, zero bytes behind."""
    word = np.zeros(len(starts), np.uint64)
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    for i in range(8):
        byte = np.where(i < lengths, padded[starts + np.minimum(i, np.maximum(lengths - 1, 0))], 0)
        word = word << np.uint64(8) | byte.astype(np.uint64)
    return word


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order by the first of ``words``, then the next: passes over 16 bits from the last ones up."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]  # counting sort for 16 bits
    return order


def _runs(new_term: np.ndarray, group: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First positions, sizes and numbers of different rows of the runs of equal term and group."""
    n = len(group)
    new_run = new_term.copy()
    new_run[1:] |= group[1:] != group[:-1]
    new_row = new_run.copy()
    new_row[1:] |= row[1:] != row[:-1]
    firsts = np.nonzero(new_run)[0]
    return firsts, np.diff(np.append(firsts, n)), np.add.reduceat(new_row, firsts, dtype=np.int64) if n else np.zeros(0, np.int64)


def counted(texts: pa.Array, group: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(group, first word, second word, long term, occurrences, rows) of the terms of some rows.

    ``group`` must not descend. Short terms come with an empty long term, long ones with zero words.
    """
    low, starts, lengths, row = terms(texts)
    out = []
    for most, words in ((8, 1), (16, 2)):
        at = np.nonzero((lengths <= most) & (lengths > most - 8))[0]
        if len(at):
            parts = [packed(low, starts[at] + 8 * i, lengths[at] - 8 * i) for i in range(words)]
            order = radix_order(parts)
            parts, at = [p[order] for p in parts], at[order]
            new = np.ones(len(at), bool)
            new[1:] = np.any([p[1:] != p[:-1] for p in parts], axis=0)
            firsts, sizes, rows = _runs(new, group[row[at]], row[at])
            parts = [p[firsts].view(np.int64) for p in parts] + [np.zeros(len(firsts), np.int64)] * (2 - words)
            out.append((group[row[at[firsts]]], parts[0], parts[1], pa.array([""] * len(firsts)), sizes, rows))
    for length in np.unique(lengths[lengths > 16]):  # a bucket per length
        at = np.nonzero(lengths == length)[0]
        held = low[spread(starts[at], lengths[at])].view(f"S{length}")  # no byte of a term is zero
        order = np.argsort(held, kind="stable")
        held, at = held[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = held[1:] != held[:-1]
        firsts, sizes, rows = _runs(new, group[row[at]], row[at])
        zero = np.zeros(len(firsts), np.int64)
        names = pa.array(held[firsts].tolist(), pa.binary()).cast(pa.string())
        out.append((group[row[at[firsts]]], zero, zero, names, sizes, rows))
    return out


def _pieces(text: pa.Array, most: int) -> Iterator[pa.Array]:
    """One long text in pieces of about ``most`` bytes that end between terms."""
    data = np.frombuffer(text.cast(pa.large_binary())[0].as_buffer(), np.uint8)
    start = 0
    while start < len(data):
        stop = min(start + most, len(data))
        while stop < len(data):  # to the next byte of no term
            breaks = np.nonzero(LOWER[data[stop : stop + most]] == 0)[0]
            stop += int(breaks[0]) if len(breaks) else len(data[stop : stop + most])
            if len(breaks):
                break
        yield pa.array([data[start:stop].tobytes()], pa.large_binary())
        start = stop


def _one_row(parts: list) -> list:
    """The counts of a text's pieces as counts of one row."""
    if not parts:
        return []
    a, b, n = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 4))
    long = pa.concat_arrays([p[3] for p in parts])
    out = []
    short = pc.equal(long, "").to_numpy(zero_copy_only=False)
    if short.any():
        words = [x[short].view(np.uint64) for x in (a, b)]
        order = radix_order(words)
        words = [x[order] for x in words]
        new = np.ones(len(order), bool)
        new[1:] = (words[0][1:] != words[0][:-1]) | (words[1][1:] != words[1][:-1])
        firsts = np.nonzero(new)[0]
        zero = np.zeros(len(firsts), np.int64)
        out.append((zero, words[0][firsts].view(np.int64), words[1][firsts].view(np.int64), pa.array([""] * len(firsts)), np.add.reduceat(n[short][order], firsts), zero + 1))
    if not short.all():
        sums = pa.table({"long": long, "n": n}).filter(pa.array(~short)).group_by("long").aggregate([("n", "sum")])
        zero = np.zeros(sums.num_rows, np.int64)
        out.append((zero, zero, zero, sums["long"].combine_chunks(), sums["n_sum"].to_numpy(), zero + 1))
    return out


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, a, b, long, n, docs): occurrences and documents of every term of each group.

    A slice of texts is counted in numpy, a text beyond the size of a slice in pieces; the sums are
    combined in the tasks before they are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                pairs: dict[tuple, int] = {}
                code = np.array([pairs.setdefault(p, len(pairs)) for p in zip(rows["lang"].to_pylist(), rows["source"].to_pylist(), strict=True)], np.int64)
                lang, source = (pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1))
                order = np.argsort(code, kind="stable")
                texts = filled(rows["text"].take(pa.array(order)))
                if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > SLICE_BYTES:
                    found = _one_row([c for piece in _pieces(texts, SLICE_BYTES) for c in counted(piece, np.zeros(1, np.int64))])
                else:
                    found = counted(texts, code[order])
                for group, a, b, long, n, held in found:
                    at = pa.array(group)
                    yield pa.RecordBatch.from_arrays([lang.take(at), source.take(at), pa.array(a), pa.array(b), long, pa.array(n), pa.array(held)], names=["lang", "source", "a", "b", "long", "n", "docs"])

    found = docs.mapInArrow(count, "lang string, source string, a long, b long, long string, n long, docs long")
    return found.groupBy("lang", "source", "a", "b", "long").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def term_text() -> Column:
    """The term of columns a, b and long."""
    zeros = "trim(TRAILING decode(unhex('00'), 'UTF-8') FROM decode(unhex(concat(hex(a), CASE WHEN b = 0 THEN '' ELSE hex(b) END)), 'UTF-8'))"
    return F.when(F.col("long") != "", F.col("long")).otherwise(F.expr(zeros))


def probability(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), in whole numbers that cannot overflow."""
    return F.expr(f"1 + CAST({n} + 2 AS DECIMAL(28, 0)) * {SCALE} div ({total} + 2 * {kept})")


def _compare(table: pa.Table, block_size: int, matrix: int) -> pa.Table:
    """Sums over a shard's terms for every pair of sources of two blocks.

    The one row with ``zero`` holds each source's probability of a term that it lacks; any other row
    is a term with the probabilities of the sources that have it.
    """
    zero = table["zero"].to_numpy()
    cells = table["cells"].combine_chunks()
    lists = cells.filter(pa.array(zero)).flatten()
    g, base = lists.field("g").to_numpy(), lists.field("p").to_numpy()
    order = np.argsort(g)
    g, base = g[order], base[order]
    x, y = (int(table[c][0].as_py()) for c in ("x", "y"))
    left, right = (np.nonzero(g // block_size == block)[0] for block in (x, y))
    sums = np.zeros((len(g), len(g)), np.int64)
    held = cells.filter(pa.array(~zero))
    step = max(1, matrix // max(len(g), 1))
    for start in range(0, len(held), step):
        part = held.slice(start, step)
        offsets = part.offsets.to_numpy()
        flat = part.flatten()
        p = np.repeat(base[:, None], len(part), axis=1)
        p[np.searchsorted(g, flat.field("g").to_numpy()), np.repeat(np.arange(len(part)), np.diff(offsets))] = flat.field("p").to_numpy()
        for i in left:
            others = right[right > i]
            apart = p[others] - p[i]
            sums[i, others] += (apart * apart // (p[others] + p[i])).sum(axis=1)  # squares stay below 2 ** 63
    i, j = np.nonzero(np.isin(np.arange(len(g)), left)[:, None] & np.isin(np.arange(len(g)), right)[None, :] & (g[:, None] < g[None, :]))
    lang = pa.array([table["lang"][0].as_py()] * len(i), pa.string())
    return pa.table({"lang": lang, "g": pa.array(g[i], pa.int32()), "h": pa.array(g[j], pa.int32()), "value": pa.array(sums[i, j])})


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): each source against the others of its language, and its own words.

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower case. A language keeps
    those in at least ``least_docs`` of its documents; V is their number, N the occurrences of all of
    them in a group. The scaled probability of a term in a group is
    p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), and two groups diverge on it by
    floor((p - q)^2 / (p + q)). Part ``pair`` has the sum over all kept terms for every other source
    of the language; part ``term`` the ``top`` terms of a source that are more probable in it than in
    its whole language. Ranks start at 1, value descending, item ascending by bytes.

    Null text, language and source count as empty ones. Sources without terms take part in pairs; in
    a language without kept terms all pairs have the value 0. A language of one source has no
    pairs. Repeated rows are documents of their own; an empty table gives no rows. Other columns
    are ignored, whatever their names. All sums are exact.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = stored(term_counts(rows))
    key = ["lang", "a", "b", "long"]
    kept = counts.groupBy(*key).agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs")).where(F.col("lang_docs") >= least_docs).drop("lang_docs")
    kept = stored(counts.drop("docs").join(kept, key))

    # One row per group and per language: numbers of terms and occurrences.
    groups = rows.select("lang", "source").distinct().join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    whole = kept.select(*key, "lang_n").distinct().groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    whole = whole.join(kept.groupBy("lang").agg(F.count("*").alias("rows")), "lang")
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g")  # the result has a row for each two of these
    groups = groups.join(whole, "lang", "left").na.fill(0, ["total", "v", "lang_total", "rows"]).select("*", number)
    groups = cut(groups.withColumn("p0", F.when(F.col("v") > 0, probability("0L", "total", "v")).otherwise(1)))

    facts = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "g", "total", "v", "lang_total")
    rated = kept.join(facts, (F.col("lang") == F.col("_lang")) & (F.col("source") == F.col("_source")))
    rated = rated.select(*key, "source", "g", probability("n", "total", "v").alias("p"), probability("lang_n", "lang_total", "v").alias("q"))

    own = rated.where("p > q").select("lang", "source", F.lit("term").alias("part"), term_text().alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    sizes = groups.groupBy("lang").agg(
        F.greatest(F.lit(1), F.ceil(F.max("rows") / GROUP_ROWS)).cast("int").alias("shards"), F.ceil(F.count("*") / SOURCES).cast("int").alias("blocks"),
        F.collect_list(F.struct("g", F.col("p0").alias("p"))).alias("cells"),
    )
    cell = F.struct("g", "p")
    by_term = rated.groupBy(*key).agg(F.collect_list(cell).alias("cells")).join(sizes.drop("cells"), "lang")
    by_term = by_term.select("lang", F.lit(False).alias("zero"), "blocks", F.pmod(F.xxhash64("a", "b", "long"), F.col("shards")).cast("int").alias("shard"), "cells")
    bases = sizes.select("lang", F.lit(True).alias("zero"), "blocks", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "cells")
    both = by_term.unionByName(bases)
    both = both.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = both.withColumn("y", F.explode(F.sequence(F.col("x"), F.col("blocks") - 1)))
    mine = F.filter("cells", lambda c: F.floor(c["g"] / SOURCES).isin(F.col("x"), F.col("y")))
    both = both.select("lang", "shard", "x", "y", "zero", F.when(F.col("blocks") == 1, F.col("cells")).otherwise(mine).alias("cells"))
    block_size, matrix = SOURCES, CELLS
    sums = both.groupBy("lang", "shard", "x", "y").applyInArrow(lambda t: _compare(t, block_size, matrix), "lang string, g int, h int, value long")
    sums = sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct(F.col("g").alias("g"), F.col("h").alias("h")), F.struct(F.col("h").alias("g"), F.col("g").alias("h"))))
    sums = sums.select("lang", "value", ends.alias("e")).select("lang", "value", "e.g", "e.h")
    named = groups.select("lang", "source", "g")
    sums = sums.join(named, ["lang", "g"]).join(named.select("lang", F.col("source").alias("item"), F.col("g").alias("h")), ["lang", "h"])
    pairs = sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    return pairs.unionByName(own)
