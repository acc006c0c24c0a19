"""Packing documents into training sequences by vector best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .batches import coded, filled, settled, slices, spread, words
from .shared import stored
from .tokens import MEMORY, encode_texts, splits_at_spaces, word_ids

SHARD_ROWS = 40_000
SLICE_BYTES = 2 << 20  # words take many times their text in arrays, and tasks of an executor hold theirs at once


def token_pieces(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", size: int = 4096, end_id: int = 1) -> DataFrame:
    """The ids of each whole text, with ``end_id`` appended, in pieces of at most ``size``.

    One row per piece: id, piece, start, length and the CRC-32 of its ids as little-endian
    unsigned 32-bit numbers. Null and empty texts give one piece that holds the end id only.
    """
    by_word = splits_at_spaces(path)
    rows = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()

    def pieces_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Of one slice; what it needed meanwhile is gone before the next slice is read."""
        place, ids = _ids(filled(batch["__text"]))
        rest = np.diff(place) + 1  # with the end id
        ends = np.cumsum(rest)
        whole_ids = np.full(int(ends[-1]), end_id, "<u4")
        own = np.ones(len(whole_ids), bool)
        own[ends - 1] = False
        whole_ids[own] = ids
        pieces = -(-rest // size)
        row = np.repeat(np.arange(len(rest)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * size
        length = np.minimum(rest[row] - start, size)
        first = (ends - rest)[row] + start
        view = memoryview(whole_ids).cast("B")
        crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch["__id"].take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
            names=[id, "piece", "start", "length", "ids_crc32"],
        )

    def _ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts and their ids one after the other."""
        if not by_word:
            lists = encode_texts(path, texts.to_pylist())
            place = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            return place, np.fromiter((i for x in lists for i in x), np.uint32, int(place[-1]))
        offsets, flat = words(texts)
        codes, distinct = coded(flat)
        del flat
        ids, bounds = word_ids(path, distinct)
        sizes = np.diff(bounds)[codes]
        place = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        return place, ids[spread(bounds[codes], sizes)]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__text", SLICE_BYTES):
                yield pieces_of(batch)

    return rows.mapInArrow(settled(cut_up, MEMORY), f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long")


def vector_best_fit(
    tokens: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, largest pieces first.

    A piece demands (tokens, 1 document, tokens squared). Of the open bins whose residuals meet
    all three demands, ``norm`` takes the one with the least weighted norm of what would remain,
    ``dot`` the one with the largest weighted dot product of demand and residual, both in shares
    of the capacities; ties go to the older bin. A piece that alone exceeds the document or
    attention capacity gets a bin of its own, so nothing is lost.
    """
    limit, w = np.array(capacity, float), np.array(weights, float)
    place, offset = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
    order = np.argsort(-tokens, kind="stable")
    least = float(tokens.min()) / limit[0] if len(tokens) else 0.0
    free = np.empty((max(1024, len(tokens) + 1), 3))
    used, opened, names = 0, 0, np.empty(len(free), np.int64)
    filled_to = np.zeros(len(tokens) + 1, np.int64)
    eps = 1e-12
    for i in order:
        need = np.array([tokens[i], 1.0, float(tokens[i]) ** 2]) / limit
        now = free[:used]
        fits = (now[:, 0] >= need[0] - eps) & (now[:, 1] >= need[1] - eps) & (now[:, 2] >= need[2] - eps)
        at = np.flatnonzero(fits)
        if len(at):
            left = now[at] - need if rule == "norm" else now[at] * need
            value = (left * left) @ w if rule == "norm" else -(left @ w)
            b = int(at[np.argmin(value)])
        else:
            b, used = used, used + 1
            free[b], names[b] = 1.0, opened
            opened += 1
        free[b] -= need
        bin_id = names[b]
        place[i], offset[i] = bin_id, filled_to[bin_id]
        filled_to[bin_id] += tokens[i]
        if free[b, 0] < least - eps or free[b, 1] < 1.0 / limit[1] - eps:  # full: no later piece fits
            used -= 1
            free[b : used] = free[b + 1 : used + 1]
            names[b : used] = names[b + 1 : used + 1]
    return place, offset


def best_fit_packing(
    pieces: DataFrame, size: int = 4096, max_documents: int = 4096, max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6), rule: str = "norm", shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Pieces are dealt over shards of about ``shard_rows`` by a hash of their content, so that the
    shards have alike mixes of lengths, and each shard is packed on its own; a shard costs at most
    one badly filled sequence. The attention capacity is ``size`` squared unless given. Repeated
    rows are packed each; an empty table gives no rows.
    """
    pieces = stored(pieces)
    shards = max(1, -(-pieces.count() // shard_rows))
    capacity = (float(size), float(max_documents), float(max_attention or size * size))
    key = F.pmod(F.xxhash64(*[F.col(c) for c in pieces.columns]), F.lit(shards))
    columns = list(pieces.columns)
    schema = StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([c for c in columns if c != "ids_crc32"], kind="stable").reset_index(drop=True)
        place, offset = vector_best_fit(rows["length"].to_numpy(np.int64), capacity, weights, rule)
        return rows[columns].assign(sequence_id=place * shards + int(key[0]), offset=offset)

    return pieces.groupBy(key.alias("__shard")).applyInPandas(pack, schema)
