"""Token counts, BPE round trips and packing against the tokenizer library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from chartloom.llm import packing, tokens
from chartloom.llm.batches import filled, settled, slices, words
from chartloom.llm.bpe import Words, bpe_round_trip, vocabulary
from chartloom.llm.packing import best_fit_packing, token_pieces, vector_best_fit
from chartloom.llm.tokens import safe_parts, token_counts, word_ids

TEXTS = [
    None, "", "   ", "Hello, wörld's <|endoftext|>x", "á İ. ΑΣ. ß… 12,345 don't", "<|ENDOFTEXT|> <|startoftext|>", "x" * 3000,
    "日本語 한국   nbsp here", "same words, same. Same", "same words, same. Same", "l'été \x1c 're's",
]


def random_texts(n, seed=5):
    rnd = random.Random(seed)
    letters = "abcdE ÉéßÅΣσ'\"<|>01 \n\t\x0b.,;日한́İŸ½😀"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library(word_bpe):
    return Tokenizer.from_file(word_bpe)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_match_the_library(docs, library, word_bpe):
    texts = TEXTS + random_texts(200)
    got = {r.doc_id: r for r in token_counts(docs(list(enumerate(texts))), word_bpe, limit=100).collect()}
    for i, text in enumerate(texts):
        assert got[i].n_tokens == len(ids_of(library, text)), text
        assert got[i].n_bytes == len((text or "").encode())
        assert got[i].over_limit == (got[i].n_tokens > 100)


def test_long_texts_are_cut_at_spaces_only(docs, library, word_bpe):
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choice("abé,.") for _ in range(rnd.randrange(1, 12))) for _ in range(300_000))
    parts = safe_parts(text.encode())
    assert len(parts) > 1 and b"".join(parts) == text.encode() and all(p[:1] == b" " for p in parts[1:])
    assert safe_parts(b"a" * 5_000_000) == [b"a" * 5_000_000]
    assert token_counts(docs([(1, text)]), word_bpe).first().n_tokens == len(ids_of(library, text))


def test_other_tokenizers_get_whole_texts(docs):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in token_counts(docs(list(enumerate(TEXTS))), path).collect()}
    assert got == {i: len(tool.encode(t or "")) for i, t in enumerate(TEXTS)}


def test_empty_table_and_null_ids(docs, word_bpe):
    assert token_counts(docs([]), word_bpe).collect() == []
    assert bpe_round_trip(docs([]), word_bpe).collect() == []
    assert token_counts(docs([(None, "a b")]), word_bpe).first().n_tokens == 2


def test_word_ids_put_texts_together(library, word_bpe):
    words = ["Thing,", "thing.", "thing", "...", "é.", "İ.", "x).", "<|endoftext|>.", "9."]
    ids, bounds = word_ids(word_bpe, pa.array(words, pa.large_string()))
    assert [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(len(words))] == [ids_of(library, w) for w in words]


def test_round_trip_matches_the_library(docs, library, word_bpe):
    texts = TEXTS + random_texts(300, 9)
    got = {r.doc_id: r for r in bpe_round_trip(docs(list(enumerate(texts))), word_bpe, with_ids=True).collect()}
    for i, text in enumerate(texts):
        ids = ids_of(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i].ids == ids and got[i].decoded == decoded, text
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_words_are_merged_once(word_bpe, monkeypatch):
    known, merged = vocabulary(word_bpe), []
    monkeypatch.setattr(type(known), "encode", lambda self, words, encode=type(known).encode: merged.extend(words) or encode(self, words))
    words = Words(known)
    first = words.converted(["Thing", "\u200b", "other"])
    assert words.converted(["other", "Thing", "new"])[:2] == [first[2], first[0]]
    assert merged == ["Thing", "\u200b", "other", "new"]


def test_merges_of_equal_symbols_go_left_to_right(library, word_bpe):
    words = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)]
    assert vocabulary(word_bpe).encode(words) == [ids_of(library, w) for w in words]


def test_pieces_and_packing(docs, library, word_bpe):
    texts = TEXTS + [" ".join(["word"] * n) for n in (15, 16, 17, 40)]
    pieces = token_pieces(docs(list(enumerate(texts))), word_bpe, size=16)
    got = best_fit_packing(pieces, size=16, shard_rows=7).collect()
    by_doc = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = [*ids_of(library, text), 1]
        assert [r.start for r in by_doc[i]] == list(range(0, len(ids), 16))
        for r in by_doc[i]:
            part = np.array(ids[r.start : r.start + 16], "<u4")
            assert r.length == len(part) and r.ids_crc32 == zlib.crc32(part.tobytes())
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(n for _, n in spans) <= 16
    assert best_fit_packing(token_pieces(docs([]), word_bpe)).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(0)
    tokens = rng.integers(1, 101, 400)
    place, offset = vector_best_fit(tokens, (100.0, 3.0, 6000.0), (1.0, 0.5, 0.5), rule)
    for b in np.unique(place):
        own = place == b
        assert tokens[own].sum() <= 100 and own.sum() <= 3
        assert (tokens[own] ** 2).sum() <= 6000 or own.sum() == 1
        order = np.argsort(offset[own])
        assert (np.cumsum(tokens[own][order]) - tokens[own][order] == offset[own][order]).all()


def test_best_fit_is_near_the_bound():
    tokens = np.random.default_rng(1).integers(1, 4097, 3000)
    place, _ = vector_best_fit(tokens, (4096.0, 4096.0, 4096.0**2), (1.0, 1e-6, 1e-6))
    assert len(np.unique(place)) <= 1.02 * tokens.sum() / 4096 + 1


def test_slices_of_a_batch_keep_their_texts():
    texts = [f"É text {i} " * (i % 7) for i in range(300)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(302)), pa.array(texts)], names=["id", "text"])
    seen = []
    for part in slices(batch, "text", 500):
        own = filled(part["text"])
        assert pc.ascii_lower(own).to_pylist() == [(t or "").replace("É", "\0").lower().replace("\0", "É") for t in part["text"].to_pylist()]
        offsets, flat = words(own)
        seen += [flat.to_pylist()[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    assert seen == [(t or "").split() for t in texts]


def test_tasks_of_other_operators_drop_the_words_a_worker_remembers(word_bpe):
    word_ids(word_bpe, pa.array(["some", "words"], pa.large_string()))
    assert list(settled(iter, tokens.MEMORY)([1, 2])) == [1, 2]
    assert tokens._KNOWN[word_bpe]
    assert list(settled(iter)([3])) == [3]
    assert not tokens._KNOWN and not tokens._KNOWN_SIZE


def test_a_slice_of_texts_is_let_go_before_the_next(docs, word_bpe, monkeypatch):
    work, text = [], "many words " * 50_000
    monkeypatch.setattr(packing, "settled", lambda cut_up, memory: work.append(cut_up) or cut_up)
    monkeypatch.setattr(packing, "SLICE_BYTES", len(text))
    token_pieces(docs([(1, "a")]), word_bpe)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([text] * 3)], names=["__id", "__text"])
    before, n = pa.total_allocated_bytes(), 0
    for pieces in work[0](iter([batch])):
        n += pieces.num_rows
        assert pa.total_allocated_bytes() - before < len(text)
    assert n == 3 * -(-100_001 // 4096)
