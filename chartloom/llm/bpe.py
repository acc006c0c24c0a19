"""Byte-pair encoding and decoding of whole texts in batched numpy merge rounds."""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .batches import coded, filled, slices, words

STOP = np.iinfo(np.int64).max
KNOWN_BYTES = 64 << 20  # of words that a Python worker remembers, with 300 bytes for each entry


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others get the letters from 256 on, in order.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, spare = [""] * 256, 256
    for byte in range(256):
        if byte in plain:
            letters[byte] = chr(byte)
        else:
            letters[byte], spare = chr(spare), spare + 1
    return letters


class Vocabulary:
    """Tables of a word-level BPE file: symbols of bytes, merges sorted by pair, names of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.names = [""] * (1 + max([*ids.values(), *self.specials.values()]))
        for name, at in [*ids.items(), *self.specials.items()]:
            self.names[at] = name
        self.width = len(self.names)
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + end] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = left * self.width + right
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.order], made
        split = next(s for s in told["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.cut = regex.compile(split["pattern"]["Regex"])
        self.special_cut = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None

    def normal(self, word: str) -> str:
        """NFC, then lower case letter by letter (a final sigma gets no form of its own)."""
        if word.isascii():
            return word.lower()
        composed = unicodedata.normalize("NFC", word)
        return "".join(c.lower() for c in composed) if "Σ" in composed else composed.lower()

    def pieces(self, word: str) -> list[str | int]:
        """Pre-tokens of a word; an int is the id of a special string in it."""
        if self.special_cut is None or "<" not in word:
            return self.cut.findall(self.normal(word))
        out, start = [], 0
        for found in self.special_cut.finditer(word):
            out += self.cut.findall(self.normal(word[start : found.start()]))
            out.append(self.specials[found.group()])
            start = found.end()
        return out + self.cut.findall(self.normal(word[start:]))

    def merge(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens one after the other, with offsets.

        All symbols stand in one array. In each round the rank of every neighbouring pair is
        found by binary search over the sorted pair keys, each pre-token picks its lowest rank
        and merges all pairs of that rank, from left to right. Pre-tokens that have nothing
        left to merge leave the array.
        """
        raw = [t.encode() for t in tokens]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(raw)), sizes)
        symbols = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        done_symbols, done_owner = [], []
        while len(symbols):
            same = owner[:-1] == owner[1:]
            keys = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where(same & (self.keys[at] == keys), self.order[at], STOP)
            rank = np.append(rank, STOP)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            span = np.diff(np.append(first, len(symbols)))
            live = np.repeat(lowest != STOP, span)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_owner.append(owner[~live])
                symbols, owner, rank = symbols[live], owner[live], rank[live]
                span, lowest = span[lowest != STOP], lowest[lowest != STOP]
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == np.repeat(lowest, span))
            # of overlapping hits, which only a pair of equal symbols has, every second one counts
            fresh = np.append(True, np.diff(hits) != 1)
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
            symbols[hits] = self.made[rank[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        symbols = np.concatenate([*done_symbols, np.zeros(0, np.int64)])
        owner = np.concatenate([*done_owner, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(raw)))])

    def encode(self, distinct: list[str]) -> list[list[int]]:
        """Ids of each word."""
        parts = [self.pieces(w) for w in distinct]
        plain = list(dict.fromkeys(p for ps in parts for p in ps if isinstance(p, str)))
        if plain:
            flat, offsets = self.merge(plain)
            ids = flat.tolist()
            bounds = offsets.tolist()
            known = {t: ids[bounds[i] : bounds[i + 1]] for i, t in enumerate(plain)}
        else:
            known = {}
        return [[i for p in ps for i in (known[p] if isinstance(p, str) else (p,))] for ps in parts]

    def decode(self, ids: list[int]) -> str:
        """The names of the ids, as a file without decoder gives them: joined by one space."""
        return " ".join(self.names[i] for i in ids)


class Words:
    """Words that this Python worker has met: each one's number of ids, its ids and its decoded text."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self.met: dict[str, tuple[int, bytes, bytes]] = {}
        self.size = 0

    def converted(self, distinct: list[str]) -> list[tuple[int, bytes, bytes]]:
        """The entry of each word; only words that are new here are merged."""
        found = list(map(self.met.get, distinct))
        new = [i for i, f in enumerate(found) if f is None]
        for i, ids in zip(new, self.known.encode([distinct[i] for i in new]), strict=True):
            found[i] = entry = (len(ids), " ".join(map(str, ids)).encode(), self.known.decode(ids).encode())
            if self.size < KNOWN_BYTES:
                self.met[distinct[i]] = entry
                self.size += 300 + len(distinct[i]) + len(entry[1]) + len(entry[2])
        return found


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.lru_cache(maxsize=2)
def met_words(path: str) -> Words:
    return Words(vocabulary(path))


def bpe_round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: id, n_tokens and digests of its ids and of their decoded text.

    ids_sha256 is taken over the decimal ids joined by one space, decoded_sha256 over the decoded
    text; ``with_ids`` adds the ids and the decoded text themselves. White space separates words
    and is dropped by the file's rules, so that the distinct words of a slice of rows are merged
    together, those that the Python worker has not met before, and documents are put together from them.

    Null and empty texts have no ids and the digests of the empty string. Rows are independent:
    repeated rows give repeated results, an empty table gives none.
    """
    rows = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    extra = ", ids array<int>, decoded string" if with_ids else ""
    kind = rows.schema["__id"].dataType.simpleString()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = met_words(path)
        for whole in batches:
            for batch in slices(whole, "__text"):
                offsets, flat = words(filled(batch["__text"]))
                codes, distinct = coded(flat)
                entries = known.converted(distinct.to_pylist())
                sizes = np.fromiter((e[0] for e in entries), np.int64, len(entries))
                as_ids, as_text = [e[1] for e in entries], [e[2] for e in entries]
                every = bool(sizes.all())  # a word may have no token at all
                counts, ids_hash, text_hash, all_ids, texts = [], [], [], [], []
                for i in range(batch.num_rows):
                    own = codes[offsets[i] : offsets[i + 1]]
                    counts.append(int(sizes[own].sum()))
                    full = own.tolist() if every else own[sizes[own] > 0].tolist()
                    decoded = b" ".join(map(as_text.__getitem__, full))
                    ids_hash.append(hashlib.sha256(b" ".join(map(as_ids.__getitem__, full))).hexdigest())
                    text_hash.append(hashlib.sha256(decoded).hexdigest())
                    if with_ids:
                        all_ids.append([int(t) for c in full for t in as_ids[c].split()])
                        texts.append(decoded.decode())
                columns = [batch["__id"], pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                names = [id, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(convert, f"`{id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}")
