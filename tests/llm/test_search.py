"""The permutation index and the term counts of sources against plain Python."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from chartloom.llm import divergence, nearest
from chartloom.llm.divergence import counted, source_divergence, terms
from chartloom.llm.nearest import Postings, footrule, nearest_neighbours, prefixes

VECTORS = "vec_id long, embedding array<float>, label int, prefix string, d int, block int, score double"


def vectors(frame, rows):
    return frame([(i, v, 1, "x", 2, 3, 0.5) for i, v in rows], VECTORS)


def neighbours(rows, k=10):
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in fine:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in fine if i != q and len(y) == len(x))
            out[q] = [(n + 1, i, round(s, 9)) for n, (s, i) in enumerate(near[:k])]
    return {q: near for q, near in out.items() if near}


def asked(df, **more):
    out = collections.defaultdict(list)
    for r in nearest_neighbours(df, "vec_id % 100 = 0", **more).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], round(r["score"], 9)))
    return dict(out)


def test_posting_lists_rank_by_footrule():
    rnd = np.random.default_rng(5)
    x, pivots = rnd.normal(size=(300, 8)), rnd.normal(size=(40, 8))
    prefix = prefixes(x, pivots)
    far = np.linalg.norm(x[:, None] - pivots[None], axis=2)
    assert (prefix == np.argsort(far, axis=1, kind="stable")[:, :10]).all()
    lists = Postings(prefix)
    for q in range(20):
        exact = np.array([footrule(prefix[q], p) for p in prefix])
        assert sorted(lists.nearest(prefix[q], 25)) == sorted(np.argsort(exact, kind="stable")[:25])


def test_small_tables_are_exact(frame):
    """Nulls, zero, non-finite and empty vectors, a null id, other dimensions, copies and ties."""
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(1, 240)]
    rows += [(300, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (400, [1.0] * 6)] + [(1000 + i, [1.0] * 6) for i in range(40)]
    rows += [(500, None), (600, [0.0] * 6), (700, [1.0, None] * 3), (800, [float("nan")] * 6), (900, [float("inf")] * 6), (1100, []), (None, [1.0] * 6)]
    rows += [(1200, [1.0, 2.0, 3.0]), (1201, [1.0, 2.0, 4.0]), (1300, [5.0])]
    assert asked(vectors(frame, rows)) == neighbours(rows)
    assert asked(vectors(frame, [])) == {} and asked(vectors(frame, [(100, [1.0])])) == {}


def test_recall_over_blocks_and_chunks(frame, monkeypatch):
    """Spread vectors, the hardest case, in several blocks; and a third of all rows is one vector."""
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 1500)
    monkeypatch.setattr(nearest, "CHUNK_ROWS", 20)
    monkeypatch.setattr(nearest, "LEAST", 64)
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(6000, 32))
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found, exact = asked(vectors(frame, rows)), neighbours(rows)
    assert found.keys() == exact.keys()
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i, _ in exact[q]}) for q in exact)
    assert hits >= 0.9 * 10 * len(exact)
    assert found[300] == exact[300]  # ties of copies go to the smallest ids


# Source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def audit(rows, least=10, top=10):
    langs = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    held = collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        own = words(text)
        langs[lang or ""][source or ""].update(own)
        held[lang or ""].update(set(own))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        whole = collections.Counter()
        for c in sources.values():
            whole.update(c)

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        rated, q = {s: p(c) for s, c in sources.items()}, p(whole)
        for s in sources:
            pairs = [(sum((rated[s][t] - rated[o][t]) ** 2 // (rated[s][t] + rated[o][t]) for t in kept), o) for o in sources if o != s]
            own = [((rated[s][t] - q[t]) ** 2 // (rated[s][t] + q[t]), t) for t in kept if sources[s][t] and rated[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", own)):
                found = sorted(found, key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, value, n + 1) for n, (value, item) in enumerate(found) if part == "pair" or n < top]
    return sorted(out)


def texts(frame, rows):
    return frame([(n, t, l, s, 1, "x", 2, 3) for n, (t, l, s) in enumerate(rows)], "doc_id long, text string, lang string, source string, a int, long string, g int, n int")


def random_rows(seed, n=400):
    rnd = random.Random(seed)
    vocabulary = ["a", "zz", "eightchr", "ninechars", "sixteen" + "x" * 9, "seventeen" + "y" * 8, "é", "ßtraße", "日本語日本語日本語", "w" * 40, "v" * 41, "Ab", "aB", "naïve"]
    vocabulary += [f"{'q' * k}{chr(97 + j)}" for k in range(20) for j in range(3)]
    marks = [" ", "\n", "1", "_", ".", "\x7f", "[", "`", "{", "@", "\x00"]

    def text():
        return "".join(rnd.choice(vocabulary) + rnd.choice(marks) for _ in range(rnd.randrange(30)))

    return [(text(), rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s1", "s1", "s2", "é", None, f"r{rnd.randrange(5)}"])) for _ in range(n)]


def test_terms_are_cut_like_the_pattern():
    rows = [t for t, _, _ in random_rows(1)] + ["", "A", "é" * 9, "1", "end", "Start 2ab"]
    low, starts, lengths, row = terms(pa.array(rows, pa.large_string()))
    found = [(int(r), low[s : s + n].tobytes().decode()) for s, n, r in zip(starts, lengths, row)]
    assert found == [(r, w) for r, t in enumerate(rows) for w in words(t)]
    assert not len(terms(pa.array([], pa.large_string()))[1])


def test_runs_count_occurrences_and_rows():
    rows = [t for t, _, _ in random_rows(4)]
    group = np.sort(np.random.default_rng(1).integers(0, 3, len(rows)))
    n, held = collections.Counter(), collections.Counter()
    for g, t in zip(group.tolist(), rows):
        n.update((g, w) for w in words(t))
        held.update({(g, w) for w in words(t)})
    total = collections.Counter()
    for g, a, b, long, count, docs in counted(pa.array(rows, pa.large_string()), group):
        for i in range(len(g)):
            packed = int(a[i]).to_bytes(8, "big", signed=True) + int(b[i]).to_bytes(8, "big", signed=True)
            term = long[i].as_py() or packed.rstrip(b"\0").decode()
            total[g[i], term] += 1
            assert (count[i], docs[i]) == (n[g[i], term], held[g[i], term])
    assert total.keys() == n.keys() and set(total.values()) == {1}


@pytest.mark.parametrize("blocks", [256, 3])
def test_audit_equals_plain_counting(frame, monkeypatch, blocks):
    """Null and empty values, equal rows, groups without terms, a language without kept terms; also many shards and blocks."""
    monkeypatch.setattr(divergence, "SOURCES", blocks)
    if blocks < 256:
        monkeypatch.setattr(divergence, "GROUP_ROWS", 40)
        monkeypatch.setattr(divergence, "CELLS", 64)
    rows = random_rows(7) + [(None, "en", "silent"), ("", "en", "quiet"), ("rare", "xx", "s1"), ("rare", "xx", "s2"), (None, "yy", None)] + [("same same", "fr", "one")] * 12
    assert sorted(tuple(r) for r in source_divergence(texts(frame, rows)).collect()) == audit(rows)


def test_long_texts_are_counted_in_pieces(frame, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 500)
    rows = [(" ".join(t for t, _, _ in random_rows(9, 60)) + "W" * 3000 + "é" * 700 + " b", "en", f"s{n % 2}") for n in range(12)] + [(None, "en", "s0")]
    assert sorted(tuple(r) for r in source_divergence(texts(frame, rows)).collect()) == audit(rows)


def test_audit_of_no_rows(frame):
    assert source_divergence(texts(frame, [])).collect() == []


def test_large_counts_stay_exact(llm):
    rows = [(10**17, 10**17 + 5, 3), (0, 0, 1), (10**12, 3 * 10**12, 10**6), (7, 10, 4)]
    df = llm.createDataFrame(rows, "n long, total long, v long").select(divergence.probability("n", "total", "v").alias("p"))
    assert [r["p"] for r in df.collect()] == [1 + 10**9 * (n + 2) // (t + 2 * v) for n, t, v in rows]
