"""Exact and near duplicates of texts and vectors against brute force."""

import hashlib
import pathlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.llm.components import components
from chartloom.llm.exact import exact_duplicates
from chartloom.llm import jaccard, shared
from chartloom.llm.jaccard import near_duplicate_groups, sketches
from chartloom.llm.shared import dropped, shuffles_released, stored
from chartloom.llm.vectors import bucket_codes, hadamard, near_duplicate_vectors, plan_for


def grouped(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def near_brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in grouped(ids, links).items()}


def corpus(seed, n=160):
    """Random texts, a large group of near copies, copies, and a passage that many texts share."""
    rnd = random.Random(seed)

    def text(k):
        return [f"w{rnd.randrange(400)}" for _ in range(k)]

    passage, base = text(30), text(60)
    rows = []
    for i in range(n):
        kind = i % 5
        if kind == 0:
            words = list(base)
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(60)] = f"x{rnd.randrange(9)}"
        elif kind == 1:
            words = text(rnd.randrange(0, 30)) + passage + text(rnd.randrange(0, 12))
        elif kind == 2:
            words = rows[rnd.randrange(len(rows))][1].split()
        elif kind == 3:
            words = text(rnd.randrange(0, 6))
        else:
            words = text(rnd.randrange(20, 90))
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("width, percent, seed", [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_near_duplicates_equal_brute_force(docs, width, percent, seed):
    rows = [*corpus(seed), (900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one TWO"), (905, "one two three four")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_groups(docs(rows), width=width, percent=percent).collect()}
    assert got == near_brute(rows, width, percent)


def test_near_duplicates_of_large_groups_near_the_threshold(docs):
    """Copies with more and fewer changes, words added and left out: many share a prefix, few link."""
    rnd = random.Random(9)
    rows = []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(150)]
        for i in range(90):
            own = list(base)
            for k in range(rnd.randrange(1, 7)):
                own[rnd.randrange(len(own))] = f"u{group}x{i}x{k}" if rnd.random() < 0.7 else f"g{group}c{rnd.randrange(9)}"
            if i % 3 == 0:
                own = own[: rnd.randrange(120, 150)] + [f"t{i}y{j}" for j in range(rnd.randrange(0, 12))]
            rows.append((group * 100 + i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_groups(docs(rows), width=4, percent=85).collect()}
    assert got == near_brute(rows, 4, 85)
    assert 3 < len({c for _, c in got.values()}) < len(rows)


def test_sketches_bound_the_difference():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(-(2**63), 2**63 - 1, size=n)) for n in (0, 1, 5, 300, 5000)]
    sets += [np.unique(np.concatenate([sets[3][20:], sets[2]]))]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    rows = sketches(np.concatenate(sets), ends)
    assert rows.shape == (len(sets), 4) and sketches(np.zeros(0, np.int64), np.zeros(1, np.int64)).shape == (0, 4)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            bits = sum(int(v).bit_count() for v in (rows[a] ^ rows[b]).view(np.uint64))
            assert bits <= len(np.setxor1d(x, y)) and (a != b or bits == 0)


def test_near_duplicates_of_odd_tables(docs):
    assert near_duplicate_groups(docs([])).collect() == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (3, "long " * 20_000)]
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicate_groups(docs(rows)).collect()), key=str)
    assert got == [(1, 1), (1, 1), (2, 2), (3, 3), (None, 1)]


def test_components(frame):
    rnd = random.Random(4)
    links = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(25)] + [(500, 500 + i) for i in range(40)]
    ids = sorted({i for link in links for i in link if link[0] != link[1]})
    got = {r.id: r.component for r in components(frame([*links, (None, 3), (7, None)], "a long, b long")).collect()}
    assert got == {i: c for i, c in grouped(ids, [x for x in links if x[0] != x[1]]).items()}
    assert components(frame([], "a long, b long")).collect() == []


def weak(column):
    """A digest that many texts share."""
    return F.unhex(F.lpad(F.hex(F.length(column) % 3), 2, "0"))


@pytest.mark.parametrize("digest", [None, weak])
def test_exact_duplicates(docs, digest):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a b", "a  b", "a\nb ", " a b", "", None, "c", "ab", f"u{i}", "a b" * 3000])) for i in range(200)]
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    by_text = {}
    for i, t in norm.items():
        by_text.setdefault(t, []).append(i)
    options = {} if digest is None else {"digest": digest}
    got = exact_duplicates(docs(rows), **options).collect()
    assert len(got) == len(rows)
    for r in got:
        group = by_text[norm[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(group), len(group), r.doc_id == min(group))
        if digest is None:
            assert bytes(r.digest) == hashlib.sha256(norm[r.doc_id].encode()).digest()


def test_exact_duplicates_of_odd_tables(docs):
    assert exact_duplicates(docs([])).collect() == []
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(docs([(None, "x"), (4, "x"), (4, "x"), (None, "y")])).collect()), key=str)
    assert got == [(4, 4, 3, True), (4, 4, 3, True), (None, 4, 3, False), (None, None, 1, True)]


def vectors_brute(rows, least):
    x = {i: np.array(v, float) for i, v in rows if v and all(e is not None and np.isfinite(e) for e in v) and any(v)}
    links = [(a, b) for a in x for b in x if a != b and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= least]
    groups = grouped([i for i, _ in rows], links)
    return {i: (sum(a == i for a, _ in links), groups[i]) for i, _ in rows}


def test_near_duplicate_vectors(frame):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 32))
    rows = [(i, [float(np.float32(e)) for e in base[i % 40] + rng.normal(size=32) * 0.25 * (i % 3)]) for i in range(240)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # one common vector
    rows += [(2000, None), (2001, []), (2002, [0.0] * 32), (2003, [1.0, None]), (2004, [float("nan")] * 32), (2005, [float("inf")] * 32)]
    rows += [(2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e-30, 2e-30]), (2009, [3.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(frame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, n int")).collect()}
    want = vectors_brute(rows, 0.9)
    assert set(got) == set(want)
    found, true = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and found >= 0.99 * true
    assert sum(got[i] != want[i] for i in want) <= 2
    assert near_duplicate_vectors(frame([], "vec_id long, embedding array<float>")).collect() == []


def test_blocks_of_a_large_bucket(frame, monkeypatch):
    monkeypatch.setattr("chartloom.llm.vectors.BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    rows = [(i, [float(np.float32(e)) for e in centre + rng.normal(size=16) * 0.2]) for i in range(90)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(frame(rows, "vec_id long, embedding array<float>")).collect()}
    want = vectors_brute(rows, 0.9)
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


@pytest.mark.parametrize("rows", [1_000, 1_000_000, 50_000_000])
def test_recall_of_the_plans(rows):
    rng = np.random.default_rng(7)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * z
    plan = plan_for(rows, 64)
    ca, cb = bucket_codes(a, plan), bucket_codes(b, plan)
    hit = (ca[:, :, :1] == cb).any(axis=2) | (cb[:, :, :1] == ca).any(axis=2)
    assert hit.any(axis=1).mean() >= 0.99


@pytest.mark.parametrize("rows, dimension, pairs", [(2 * 10**9, 64, 1000), (10**6, 384, 1500), (10**9, 384, 1000), (10**12, 384, 300), (10**6, 1024, 500)])
def test_recall_of_wide_vectors_and_four_functions(rows, dimension, pairs):
    rng = np.random.default_rng(7)
    a = rng.normal(size=(pairs, dimension))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * z
    plan = plan_for(rows, dimension)
    ca, cb = bucket_codes(a, plan), bucket_codes(b, plan)
    hit = (ca[:, :, :1] == cb).any(axis=2) | (cb[:, :, :1] == ca).any(axis=2)
    assert hit.any(axis=1).mean() >= 0.9965


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose((hadamard(x) ** 2).sum(axis=1), (x**2).sum(axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


def test_near_duplicates_keep_no_rows_that_the_result_does_not_read(docs, spark, monkeypatch, tmp_path):
    """Shingle sets, postings and full sets of every round stayed on the disk before."""
    monkeypatch.setattr(jaccard, "PASS_SHINGLES", 10)  # several passes, on a small table too
    rnd = random.Random(8)
    base = [" ".join(rnd.choice("abcdefghij") + str(rnd.randrange(40)) for _ in range(60)) for _ in range(20)]
    rows = [(i, base[i % 20] + " end" * (i // 20)) for i in range(60)] + [(90, None), (91, "")]
    shared.shared_folder(spark)  # checkpoints need one
    monkeypatch.setattr(shared, "shared_folder", lambda _: str(tmp_path))
    found = near_duplicate_groups(docs(rows), width=4, percent=85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == near_brute(rows, 4, 85)
    read = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in found.inputFiles()}
    assert {p.name for p in tmp_path.iterdir()} == {r for r in read if r.startswith("chartloom-llm-rows-")}


def test_steps_release_their_shuffles_and_rows(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    with shuffles_released(spark):
        assert spark.conf.get(setting) == "true"
        rows = stored(spark.range(50).repartition(3))
    assert spark.conf.get(setting) == before and rows.count() == 50
    path = f"{tmp_path}/given"
    rows.write.parquet(path)
    files = rows.inputFiles()
    dropped(rows, spark.read.parquet(path))  # rows that stored did not write stay
    assert not [f for f in files if pathlib.Path(f.removeprefix("file://")).exists()]
    assert spark.read.parquet(path).count() == 50
