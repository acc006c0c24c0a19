"""Language identification by unigram piece models, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability of
a word is the sum over all ways to cut it into pieces (forward algorithm), and that of a text the
product over its words. The piece probabilities are fitted by expectation maximisation on a
bounded sample of labelled documents; what a text is judged by is its text alone.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .batches import coded, filled, row_sums, settled, slices, words
from .shared import cut

START = "▁"  # how the vocabulary marks the beginning of a word
LONGEST_WORD = 20  # letters; longer runs of letters are scored in parts of this length
LONGEST_PIECE = 12
BASE = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = 1e-8  # probability of a letter outside the vocabulary, the same for all languages
SLICE_BYTES = 3 << 20
LOT_WORDS = 6_000  # words of one length that are cut up at once
FIT_TASKS = 12  # the counted words of the bounded sample are dealt over so many tasks


@functools.lru_cache(maxsize=2)
def piece_keys(path: str) -> np.ndarray:
    """Sorted hashes of the vocabulary's lower-case pieces of letters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    fit = [p for p in pieces if 0 < len(p) <= LONGEST_PIECE and p.replace(START, "", 1).isalpha() or p == START]
    keys = np.unique(np.array([_hash(p) for p in fit], np.uint64))
    if len(keys) != len(fit):
        raise ValueError("two pieces share a hash")
    return keys


def _hash(piece: str) -> int:
    value = 0
    for letter in piece:
        value = (value * int(BASE) + ord(letter) + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def letter_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lower-case runs of letters of each text."""
    return words(pc.utf8_lower(pc.replace_substring_regex(texts, r"[^\p{L}]+", " ")))


@functools.lru_cache(maxsize=2)
def _seen_heads(path: str) -> np.ndarray:
    """Whether any piece's hash begins with given 20 bits; most substrings are told apart by this alone."""
    seen = np.zeros(1 << 20, bool)
    seen[(piece_keys(path) >> np.uint64(44)).astype(np.int64)] = True
    return seen


@dataclasses.dataclass
class Lattice:
    """All pieces in words of one length: arcs (start, end, word numbers, piece numbers).

    ``members`` are indices into the given words; a long word stands once for each of its parts.
    A letter that is no piece has the number after the last piece.
    """

    members: np.ndarray
    length: int
    arcs: list[tuple[int, int, np.ndarray, np.ndarray]]


def lattices(distinct: list[str], path: str) -> Iterator[Lattice]:
    keys, seen = piece_keys(path), _seen_heads(path)
    by_length: dict[int, list[tuple[int, str]]] = {}
    for i, word in enumerate(distinct):
        for start in range(0, len(word), LONGEST_WORD):
            part = (START if start == 0 else "") + word[start : start + LONGEST_WORD]
            by_length.setdefault(len(part), []).append((i, part))
    for length, parts in by_length.items():
        for at in range(0, len(parts), LOT_WORDS):
            some = parts[at : at + LOT_WORDS]
            letters = np.frombuffer("".join(p for _, p in some).encode("utf-32-le"), np.uint32).reshape(len(some), length)
            letters = np.ascontiguousarray(letters.T).astype(np.uint64) + np.uint64(1)
            arcs = []
            for start in range(length):
                value = np.zeros(len(some), np.uint64)
                for span in range(1, min(LONGEST_PIECE, length - start) + 1):
                    value = value * BASE + letters[start + span - 1]
                    word = np.flatnonzero(seen[(value >> np.uint64(44)).astype(np.int64)])
                    piece = np.minimum(np.searchsorted(keys, value[word]), len(keys) - 1)
                    found = keys[piece] == value[word]
                    word, piece = word[found], piece[found]
                    if span == 1:
                        all_pieces = np.full(len(some), len(keys))
                        all_pieces[word] = piece
                        word, piece = np.arange(len(some)), all_pieces
                    if len(word):
                        arcs.append((start, start + span, word, piece))
            yield Lattice(np.array([i for i, _ in some]), length, arcs)


def with_unknown(chances: np.ndarray) -> np.ndarray:
    """Piece probabilities, one column per language, with the fixed one of unknown letters at the end."""
    return np.ascontiguousarray(np.vstack([chances.T, np.full(chances.shape[0], UNKNOWN)]))


def forward(lattice: Lattice, table: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of the words' beginnings: [end, word, language]."""
    alpha = np.zeros((lattice.length + 1, len(lattice.members), table.shape[1]))
    alpha[0] = 1.0
    for start, end, word, piece in lattice.arcs:  # by start, so alpha[start] is complete
        alpha[end, word] += alpha[start, word] * table[piece]
    return alpha


def expected_counts(distinct: list[str], times: np.ndarray, chances: np.ndarray, path: str) -> tuple[np.ndarray, float]:
    """Expected uses of each piece over all segmentations, for one language; and the log-likelihood."""
    table = with_unknown(chances[None, :])
    total, fit = np.zeros(len(table)), 0.0
    for lattice in lattices(distinct, path):
        alpha = forward(lattice, table)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[lattice.length] = 1.0
        for start, end, word, piece in reversed(lattice.arcs):
            beta[start, word] += table[piece, 0] * beta[end, word]
        whole = alpha[lattice.length]
        n = times[lattice.members] / whole
        fit += float(times[lattice.members] @ np.log(whole))
        for start, end, word, piece in lattice.arcs:
            total += np.bincount(piece, alpha[start, word] * table[piece, 0] * beta[end, word] * n[word], minlength=len(table))
    return total[:-1], fit


@dataclasses.dataclass(frozen=True)
class LanguageModel:
    """Languages in order and their piece probabilities, one row each."""

    languages: tuple[str, ...]
    chances: np.ndarray
    vocabulary: str


def fit(
    labelled: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = 600, rounds: int = 3, smoothing: float = 0.05,
) -> LanguageModel:
    """Piece probabilities of each language by expectation maximisation.

    About ``per_language`` documents of each language, picked by a hash of the id, are the bounded
    sample; whole texts are used. Words are counted in Spark, and in each round tasks send expected
    piece counts, at most (languages x pieces) numbers, which the driver normalises. Rows with a
    null text, language or id are not learned from.
    """
    known = labelled.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not sizes:
        return LanguageModel((), np.zeros((0, len(piece_keys(vocabulary)))), vocabulary)
    share = F.create_map(*[x for name, n in sizes.items() for x in (F.lit(name), F.lit(per_language / n))])
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
    sample = known.where(draw < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                offsets, flat = letter_words(filled(batch["text"]))
                langs = batch["lang"].take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(offsets))))
                table = pa.table({"lang": langs, "word": flat.cast(pa.string())})
                table = table.group_by(["lang", "word"]).aggregate([([], "count_all")])
                yield from table.select(["lang", "word", "count_all"]).rename_columns(["lang", "word", "n"]).to_batches()

    words_of = sample.select("text", "lang").mapInArrow(settled(count), "lang string, word string, n long")
    counts = cut(words_of.groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition(FIT_TASKS))
    names = tuple(sorted(sizes))
    n_pieces = len(piece_keys(vocabulary))
    chances = np.full((len(names), n_pieces), 1.0 / n_pieces)
    for _ in range(rounds):
        at = LanguageModel(names, chances, vocabulary)

        def expect(batches: Iterator[pa.RecordBatch], model: LanguageModel = at) -> Iterator[pa.RecordBatch]:
            totals = np.zeros_like(model.chances)
            for batch in batches:
                for i, name in enumerate(model.languages):
                    own = batch.filter(pc.equal(batch["lang"], name))
                    if own.num_rows:
                        totals[i] += expected_counts(own["word"].to_pylist(), own["n"].to_numpy().astype(float), model.chances[i], model.vocabulary)[0]
            for i in range(len(model.languages)):
                piece = np.flatnonzero(totals[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(piece), i, np.int32)), pa.array(piece.astype(np.int32)), pa.array(totals[i, piece])],
                    names=["language", "piece", "n"],
                )

        sums = counts.mapInArrow(settled(expect), "language int, piece int, n double").groupBy("language", "piece").agg(F.sum("n").alias("n"))
        got = sums.toPandas()  # at most languages x pieces rows
        raw = np.zeros_like(chances)
        raw[got["language"].to_numpy(), got["piece"].to_numpy()] = got["n"].to_numpy()
        chances = (raw + smoothing) / (raw + smoothing).sum(axis=1, keepdims=True)
    return LanguageModel(names, chances, vocabulary)


def word_scores(distinct: list[str], model: LanguageModel) -> np.ndarray:
    """Log-probability of each word in each language."""
    table = with_unknown(model.chances)
    out = np.zeros((len(distinct), len(model.languages)))
    for lattice in lattices(distinct, model.vocabulary):
        np.add.at(out, lattice.members, np.log(forward(lattice, table)[lattice.length]))
    return out


def with_language(docs: DataFrame, model: LanguageModel, text: str, keep: list[Column], kept_text: str | None = None) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score of its whole text.

    If one of the kept columns is the text, ``kept_text`` names it, so that it travels once.

    The score is the posterior of the language under equal priors. A null text, or one without
    letters, is ``und`` with score 0, as is every text if no language was learned. Ties go to the
    first language in order. Rows are independent of each other.
    """
    judged = kept_text or "__text"
    rows = docs.select(*keep) if kept_text else docs.select(*keep, F.col(text).alias("__text"))
    schema = StructType([f for f in rows.schema if kept_text or f.name != "__text"]).add("lang_pred", "string").add("score", "double")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x pieces numbers

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for batch in slices(whole, judged, SLICE_BYTES):
                offsets, flat = letter_words(filled(batch[judged]))
                names, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
                if model.languages and len(flat):
                    codes, distinct = coded(flat)
                    sums = row_sums(word_scores(distinct.to_pylist(), model)[codes], offsets)
                    best = sums.argmax(axis=1)
                    some = np.diff(offsets) > 0
                    chance = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    names = [model.languages[b] if s else "und" for b, s in zip(best, some, strict=True)]
                    score = np.where(some, chance, 0.0)
                fixed = [c for c in batch.schema.names if kept_text or c != "__text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c] for c in fixed), pa.array(names, pa.string()), pa.array(score)], names=[*fixed, "lang_pred", "score"]
                )

    return rows.mapInArrow(settled(judge), schema)


def held_out(id: str) -> Column:
    """Whether a document's language is never learned from; a null id is not held out, nor learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def language_id(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score; learned from the documents not held out."""
    model = fit(docs.where(F.crc32(F.col(id).cast("string").cast("binary")) % 5 != 0), vocabulary, id, text, lang)
    return with_language(docs, model, text, [F.col(id), held_out(id).alias("held_out")])
