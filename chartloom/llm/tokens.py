"""Token ids and counts of whole texts by a public tokenizer file."""

from __future__ import annotations

import array
import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .batches import SPACES, coded, filled, remembered, row_sums, settled, slices, spread, words

PART_BYTES = 1 << 20  # a longer text is encoded in parts
ENCODE_BYTES = 1 << 18  # texts given to the tokenizer at once
KNOWN_BYTES = 80 << 20  # of words, whose ids a Python worker remembers, with 150 bytes for each entry


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The library of the file by its ending; loaded once in each Python worker."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        return loaded
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def splits_at_spaces(path: str) -> bool:
    """Whether the file's pre-tokenizer drops white space, so that every space is a safe boundary."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    steps = (described.get("pre_tokenizer") or {}).get("pretokenizers", [])
    words_only = [s for s in steps if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"]]
    added = described.get("added_tokens", [])
    return bool(words_only) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in added)


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Lists of about equal bytes, whatever the lengths of the texts."""
    group, size = [], 0
    for text in texts:
        length = len(text) if text.isascii() else len(text.encode())
        if group and size + length > ENCODE_BYTES:
            yield group
            group, size = [], 0
        group.append(text)
        size += length
    if group:
        yield group


def encode_texts(path: str, texts: list[str]) -> list[list[int]]:
    """Ids of each text, without added special tokens, in balanced calls."""
    tool = _tokenizer(path)
    out: list[list[int]] = []
    for group in _groups(texts):
        if path.endswith(".json"):
            out += [e.ids for e in tool.encode_batch_fast(group, add_special_tokens=False)]
        else:
            out += tool.encode(group, num_threads=1)
    return out


def safe_parts(text: bytes, limit: int = PART_BYTES) -> list[bytes]:
    """A long text cut before white space; no part is longer than ``limit`` unless it has none to cut at."""
    parts, start = [], 0
    while len(text) - start > limit:
        cut = max(text.rfind(bytes([s]), start + 1, start + limit) for s in SPACES)
        if cut <= start:
            later = [p for s in SPACES if (p := text.find(bytes([s]), start + limit)) > 0]
            if not later:
                break
            cut = min(later)
        parts.append(text[start:cut])
        start = cut
    return [*parts, text[start:]]


@functools.lru_cache(maxsize=4)
def _folds(path: str) -> bool:
    """Whether the file lower-cases texts and never joins letters or digits with other characters."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    normal = [n["type"] for n in (described.get("normalizer") or {}).get("normalizers", [])]
    cut = [s["pattern"].get("Regex", "") for s in described["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
    return "Lowercase" in normal and cut[0].endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


_KNOWN: dict[str, dict[str, bytes]] = {}  # by file: ids of words that this Python worker has met
_KNOWN_SIZE: dict[str, int] = {}
MEMORY = "token ids"


def _forget() -> None:
    _KNOWN.clear()
    _KNOWN_SIZE.clear()
    _tokenizer.cache_clear()


remembered(MEMORY, _forget)


def _known_ids(path: str, texts: list[str]) -> list[bytes]:
    """Ids of each word as 32-bit numbers; the library sees only words that are new to this worker."""
    known = _KNOWN.setdefault(path, {})
    found = list(map(known.get, texts))
    new = [i for i, f in enumerate(found) if f is None]
    size = _KNOWN_SIZE.get(path, 0)
    for i, ids in zip(new, encode_texts(path, [texts[i] for i in new]), strict=True):
        found[i] = array.array("I", ids).tobytes()
        if size < KNOWN_BYTES:
            known[texts[i]] = found[i]
            size += 150 + len(texts[i]) + len(found[i])
    _KNOWN_SIZE[path] = size
    return found


def word_ids(path: str, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words one after the other, with offsets.

    Where the file's rules allow it, words are taken in lower case and without trailing stops and
    commas, whose ids follow, so that fewer different words need encoding. Words with a ``<`` stay
    as they are, for they may hold special strings.
    """
    if not _folds(path):
        flat = _known_ids(path, distinct.to_pylist())
        sizes = np.fromiter(map(len, flat), np.int64, len(flat)) // 4
        return np.frombuffer(b"".join(flat), np.uint32), np.concatenate([[0], np.cumsum(sizes)])
    special = pc.match_substring(distinct, "<")
    lower = pc.if_else(special, distinct, pc.ascii_lower(distinct))
    core = pc.utf8_rtrim(lower, ".,")
    whole = pc.or_(special, pc.ends_with(core, "İ"))  # its lower case ends in a mark, which joins stops
    apart = pc.and_(pc.match_substring_regex(core, r"[\p{L}\p{N}]$"), pc.invert(whole))
    core = pc.if_else(apart, core, lower)
    cores, names = coded(core)
    tails, ends = coded(pc.if_else(apart, pc.replace_substring_regex(lower, r"^.*?([.,]*)$", r"\1"), ""))
    parts = np.stack([cores, tails.astype(np.int64) + len(names)], axis=1).ravel()
    flat = _known_ids(path, names.to_pylist() + ends.to_pylist())
    sizes = np.fromiter(map(len, flat), np.int64, len(flat)) // 4
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    ids = np.frombuffer(b"".join(flat), np.uint32)[spread(starts[parts], sizes[parts])]
    return ids, np.concatenate([[0], np.cumsum(sizes[parts].reshape(-1, 2).sum(axis=1))])


def _counts(texts: pa.Array, path: str, by_word: bool) -> np.ndarray:
    if by_word:
        offsets, flat = words(texts)
        codes, distinct = coded(flat)
        return row_sums(np.diff(word_ids(path, distinct)[1])[codes], offsets)
    return np.fromiter(map(len, encode_texts(path, texts.to_pylist())), np.int64, len(texts))


def with_token_counts(docs: DataFrame, path: str, text: str, keep: list[Column], limit: int) -> DataFrame:
    """``keep`` columns of every row with n_bytes, n_tokens and over_limit of its whole text.

    Only lengths leave the Arrow function. Where the tokenizer drops white space, each slice of
    rows is cut at white space, its distinct words are encoded once, in calls of about equal
    bytes, and their counts are added up; long texts are cut into parts first. Other tokenizers
    get whole texts, since no boundary is safe for them.

    Null and empty texts have 0 bytes and 0 tokens. Rows are independent, so repeated rows,
    null ids, empty tables and further columns change nothing.
    """
    by_word = splits_at_spaces(path)
    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = rows.drop("__text").schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__text"):
                texts = filled(batch["__text"])
                n_bytes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
                if by_word and len(texts) == 1 and n_bytes[0] > PART_BYTES:
                    parts = pa.array(safe_parts(texts[0].as_buffer().to_pybytes()), pa.large_binary()).cast(pa.large_string())
                    n_tokens = np.array([sum(int(_counts(parts.slice(i, 1), path, True)[0]) for i in range(len(parts)))])
                else:
                    n_tokens = _counts(texts, path, by_word)
                fixed = [batch[c] for c in batch.schema.names if c != "__text"]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)],
                    names=[c for c in batch.schema.names if c != "__text"] + ["n_bytes", "n_tokens", "over_limit"],
                )

    return rows.mapInArrow(settled(count, MEMORY), schema)


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """One row per document: its id, n_bytes, n_tokens and whether it has more than ``limit`` tokens."""
    return with_token_counts(docs, path, text, [F.col(id)], limit)
