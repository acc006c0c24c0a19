"""Language identification, archives, url verdicts, personal data, pipeline and registration."""

import base64
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from chartloom.llm import langid, pii, urls, warc

LANGUAGES = {
    "aa": ["the", "then", "there", "house", "water", "stone", "thing", "with"],
    "bb": ["der", "und", "haus", "wasser", "stein", "mit", "nicht", "schön"],
}


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def spoken(rnd, lang, n=40):
    return " ".join(rnd.choice(LANGUAGES[lang]) for _ in range(n))


def test_languages_are_told_apart_on_held_out_texts(frame, pieces):
    rnd = random.Random(1)
    rows = [(i, spoken(rnd, lang), lang, "s", 1) for i in range(120) for lang in [rnd.choice(["aa", "bb"])]]
    odd = [(900, None, "aa", "s", 1), (901, "", "bb", "s", 1), (902, "12 34 !?", "aa", "s", 1), (903, "und " * 50_000, None, "s", 1), (None, "the house", "aa", "s", 1)]
    df = frame(rows + odd, "doc_id long, text string, lang string, lang_pred string, id int")
    got = {r.doc_id: r for r in langid.language_id(df, pieces).collect()}
    for i, _, lang, *_ in rows:
        assert got[i].lang_pred == lang and 0.5 < got[i].score <= 1
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "bb", "aa"]
    assert got[900].score == 0 and got[None].held_out is False


def test_no_label_means_no_language(frame, pieces):
    df = frame([(1, "the house", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.language_id(df, pieces).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert langid.language_id(df.limit(0), pieces).collect() == []


def segmentations(word):
    if not word:
        yield []
    for n in range(1, min(len(word), langid.LONGEST_PIECE) + 1):
        for rest in segmentations(word[n:]):
            yield [word[:n], *rest]


def test_forward_sums_over_all_segmentations(pieces):
    keys = langid.piece_keys(pieces)
    rng = np.random.default_rng(2)
    chances = rng.random((2, len(keys)))
    chances /= chances.sum(axis=1, keepdims=True)
    number = {int(k): i for i, k in enumerate(keys)}

    def chance(piece, language):
        at = number.get(langid._hash(piece))
        return chances[language, at] if at is not None else (langid.UNKNOWN if len(piece) == 1 else 0.0)

    words = ["house", "schön", "日本", "a", "zzq"]
    got = langid.word_scores(words, langid.LanguageModel(("x", "y"), chances, pieces))
    for i, word in enumerate(words):
        for language in range(2):
            total = sum(np.prod([chance(p, language) for p in cut]) for cut in segmentations(langid.START + word))
            assert np.isclose(got[i, language], np.log(total))


def test_fitting_never_lowers_the_likelihood(pieces):
    keys = langid.piece_keys(pieces)
    words, times = LANGUAGES["bb"], np.arange(1.0, 9.0)
    chances, last = np.full(len(keys), 1 / len(keys)), -np.inf
    for _ in range(4):
        counts, fit = langid.expected_counts(words, times, chances, pieces)
        assert fit >= last - 1e-9
        chances, last = counts / counts.sum(), fit


# ---------------------------------------------------------------- archives


def test_archives_come_back_whole(llm, frame, tmp_path):
    rnd = random.Random(3)
    pages = [(i, f"http://h/{i}", rnd.choice([None, "", "<p>same</p>", f"<p>own {i} é</p>", "long " * 40_000])) for i in range(120)] + [(500, None, "x"), (None, "u", "y")]
    df = frame([(*p, 1, "q") for p in pages], "page_id long, url string, html string, id int, payload string")
    got = {r.page_id: r for r in warc.archived_pages(df, str(tmp_path)).collect()}
    assert len(got) == len(pages)
    last = {}
    for i, _, html in pages:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", -1))
    for i, _, html in pages:
        payload = (html or "").encode()
        response = last.get(html or "", i)
        assert got[i].payload_bytes == len(payload) and got[i].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if i is None or i == response else ("revisit", response))
    path = next(tmp_path.glob("warc-*"))
    texts = {r.record_id: r.payload for r in warc.read_archives(llm, str(path), with_payload=True).collect() if r.record_type == "response"}
    assert {v.decode() for v in texts.values()} == {h or "" for _, _, h in pages}
    for part in path.glob("part-*"):
        data = part.read_bytes()
        frames = list(warc.read_frames(data))
        if struct.unpack_from("<I", data)[0] == warc.DICTIONARY_FRAME:
            assert len(frames) > 8
    small = warc.archived_pages(df, str(tmp_path), least=5).where("payload_bytes < 5")
    assert {r.record_type for r in small.collect()} == {"response"}
    assert warc.archived_pages(df.limit(0), str(tmp_path)).collect() == []


def record(payload=b"hello", **changes):
    return warc._record("1", "http://h/", payload, warc.base32_sha1(payload), None)


def packed(*records, dictionary=None):
    tool = zstandard.ZstdCompressor(dict_data=dictionary)
    return b"".join(map(tool.compress, records))


def test_reader_accepts_both_forms_of_a_dictionary():
    samples = [record(f"<p>page {i} of many</p>".encode() * 3) for i in range(200)]
    known = zstandard.train_dictionary(4096, samples)
    for body in (known.as_bytes(), zstandard.compress(known.as_bytes())):
        data = struct.pack("<II", warc.DICTIONARY_FRAME, len(body)) + body + packed(*samples, dictionary=known) + warc.SEPARATOR.encode()
        assert list(warc.read_frames(data)) == samples


def test_reader_rejects_damage():
    good = packed(record())
    assert warc.parse_record(next(warc.read_frames(good)))["payload"] == b"hello"
    for bad in (good[:-3], b"junk" + good, struct.pack("<II", warc.DICTIONARY_FRAME, 99) + b"x", good + struct.pack("<II", warc.DICTIONARY_FRAME, 0)):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_frames(bad))
    for old, new in (
        (b"WARC/1.1", b"WARC/9"), (b"hello", b"hullo"), (b"Content-Length: 5", b"Content-Length: 6"), (b"WARC-Type: response", b"WARC-Type: odd"),
        (b"WARC-Date: ", b"WARC-Day: "), (b"WARC-Date:", b"WARC-Date"), (b"WARC-Record-ID", b"WARC-Type"),
    ):
        with pytest.raises(ValueError):
            warc.parse_record(record().replace(old, new))


# ---------------------------------------------------------------- urls

RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/")]


def url_brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = max((r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_url_parts_and_rules(frame):
    rnd = random.Random(4)
    some = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.Org/es/1", "http://a.example.org/en/12?x=http://b/", "http://É.com/fr/", "http://com/de/#/fr/", "http://x.com?/fr/", "http://xorg/", "http://org"]
    some += [f"http://{rnd.choice(['a.', ''])}{rnd.choice(['example.org', 'b.com', 'c.net'])}/{rnd.choice(['en', 'es', 'fr', 'de'])}/{rnd.randrange(300)}" for _ in range(200)]
    df = frame([(i, u, "h", "p") for i, u in enumerate(some)], "page_id long, url string, host string, node string")
    got = {r.page_id: r for r in urls.url_verdicts(df, RULES).collect()}
    assert len(got) == len(some)
    for i, u in enumerate(some):
        host, path, rule, verdict = url_brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert urls.url_verdicts(df.limit(0), RULES).collect() == []


def test_templates_carry_labels_to_urls_without_rules(frame):
    """Below /shop/ nearly all labels are bad, below /docs/ nearly all good."""
    rules = [urls.Rule("block", "h.net", f"/shop/{d}") for d in range(1, 8)] + [urls.Rule("allow", "h.net", f"/docs/{d}") for d in range(1, 8)]
    rows = [(i, f"http://h.net/{'shop' if i % 2 else 'docs'}/{100 + i * 7}.html") for i in range(130)]
    got = urls.url_verdicts(frame(rows, "page_id long, url string"), rules).collect()
    free = [r for r in got if r.rule is None]
    assert free and all(r.verdict == ("block" if "/shop/" in r.path else "allow") for r in free)
    assert {r.template for r in free} == {"h.net/shop/*.html", "h.net/docs/*.html"}
    same = urls.url_verdicts(frame(rows, "page_id long, url string"), [])
    assert {r.verdict for r in same.collect()} == {"allow"}


def test_templates_go_below_six_levels(frame):
    words = [f"{k}{chr(97 + i)}" for k in "sd" for i in range(26)]
    deep = {w: f"/a/b/c/d/e/f/{w}/{'shop' if w[0] == 's' else 'docs'}" for w in words}
    rules = [urls.Rule("block" if w[0] == "s" else "allow", "h.net", deep[w]) for w in words if w[1] < "h"]
    got = urls.url_verdicts(frame([(w, f"http://h.net{deep[w]}") for w in words], "page_id string, url string"), rules).collect()
    assert {(r.page_id[0], r.verdict) for r in got} == {("s", "block"), ("d", "allow")}
    assert len({r.template for r in got}) == 2



# ---------------------------------------------------------------- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def pii_brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def spans_of(value):
    return [(s.kind, s.start, s.end) for s in value]


def test_base_spans_equal_brute_force(docs):
    rnd = random.Random(6)
    bits = ["a@b.co", "a@b.c_d@e.f", "x@y", "a@b..c", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.255", "99999999999.1.1.1", "4111 1111-1111 1111", "4111111111111111",
            "4111  1111", "4242424242424242424242", "+1 (522) 555-2314", "+1-23", "+1234567890123456", "é", "😀", " ", "  ", ".", "-", "@", "+", "7", "12", "a", "\n", "0000000000000"]
    texts = [None, "", "a@b.c" * 3, "a" * 100_000, "1" * 50_000, "a.b@" + "c." * 5_000 + "d", "+" * 1000, "1 " * 30_000]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randrange(14))) for _ in range(600)]
    got = {r.doc_id: r for r in pii.personal_data(docs(list(enumerate(texts)))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert spans_of(got[i].base) == pii_brute(text), text
        assert set(spans_of(got[i].base)) <= set(spans_of(got[i].spans))
    assert pii.personal_data(docs([])).collect() == []


def test_cues_find_identifiers_of_other_forms(docs):
    """After enough phone numbers that follow one cue, a number without a plus sign there is one as well."""
    rows = [(i, f"text {i} please call me at +1 (522) 555-{2000 + i} now") for i in range(12)]
    rows += [(100 + i, f"w{i} Tel: +1 (522) 555-{3000 + i}") for i in range(9)] + [(200, "other Tel: 522-555-9999.")]
    rows += [(300 + i, f"the {v}") for i, v in enumerate(["a@b.co", "1.2.3.4", "4111111111111111"] + [f"+1 (522) 555-{4000 + i}" for i in range(8)] + [f"x{i}@b.co" for i in range(8)])] + [(400, "the 522 555 1111")]
    rows += [(50, "é please call me at 522 555 7777 now"), (51, "an item number 522 555 7777 is sold"), (52, "the code was 522 555 8888 then")]
    got = {r.doc_id: spans_of(r.spans) for r in pii.personal_data(docs(rows), rounds=3).collect()}
    at = len("é please call me at ")
    assert got[50] == [("phone", at, at + 12)]
    assert got[52] == [] and got[400] == []  # no cue, and one that stands before anything
    assert got[200] == [("phone", 11, 23)]
    assert got[51] == [("phone", 15, 27)]  # the same number again


def test_redaction(docs):
    rows = [(1, "mail é a@b.co, ip 1.2.3.4"), (2, "nothing"), (3, None), (4, "+1 (522) 555-2314")]
    body = F.coalesce("text", F.lit(""))
    got = {r.doc_id: r.t for r in docs(rows).select("doc_id", pii.redacted(F.col("text"), pii.base_spans(body)).alias("t")).collect()}
    assert got == {1: "mail é [EMAIL], ip [IP]", 2: "nothing", 3: None, 4: "[PHONE]"}


def test_very_many_identifiers_in_one_text(docs):
    """Base spans, overlaps and redaction of a long text, against a walk in Python."""
    bits = ["é😀", "522 555 1234", "a{}@b.co", "1.2.3.4", "+1 (522) 555-2314", "4111 1111 1111 1111", "word{}"]
    rnd = random.Random(9)
    text = " ".join(rnd.choice(bits).format(i) for i in range(30_000))
    row = docs([(1, text), (2, "word " * 60_000)]).select("doc_id", "text")
    got = {r.doc_id: r for r in pii.personal_data(row).collect()}
    base = pii_brute(text)
    assert spans_of(got[1].base) == base and spans_of(got[2].spans) == []
    added = set(spans_of(got[1].spans)) - set(base)
    covered = {i for _, a, b in base for i in range(a, b)}
    assert not any(i in covered for _, a, b in added for i in range(a, b))
    out, at = "", 0
    for kind, a, b in sorted(base, key=lambda s: s[1]):
        if a >= at:
            out += text[at:a] + f"[{kind.upper()}]"
        at = max(at, b)
    new = row.select("doc_id", pii.redacted(F.col("text"), pii.base_spans(F.col("text"))).alias("t"))
    assert {r.doc_id: r.t for r in new.collect()} == {1: out + text[at:], 2: "word " * 60_000}


def test_native_operators_run_no_python(docs, frame):
    from chartloom.llm.exact import exact_duplicates

    plans = [pii.personal_data(docs([(1, "a")])), exact_duplicates(docs([(1, "a")])), urls.url_verdicts(frame([(1, "http://a/b")], "page_id long, url string"), RULES)]
    for df in plans:
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# ---------------------------------------------------------------- pipeline and registration


def test_pipeline_keeps_and_drops_what_it_should(llm, tmp_path):
    import corpus_pipeline

    rnd = random.Random(8)
    base = " ".join(f"word{rnd.choice('abcdefgh')}{rnd.choice('abcdefgh')}{rnd.choice('abcdefgh')}" for _ in range(80))
    rows = [(0, base), (1, base.replace(" ", "\n", 1)), (2, base + " tail"), (3, "unlike text mail a@b.co"), (4, None), (5, "123 !!")]
    df = llm.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    docs = llm.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(llm, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{i}"))
        columns = docs.columns
        docs = llm.read.parquet(str(tmp_path / f"out{i}"))
        kept[name] = docs
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    ids = {n: sorted(r.doc_id for r in d.select("doc_id").distinct().collect()) for n, d in kept.items()}
    assert ids["language_id"] == [0, 1, 2, 3] and ids["exact_dedup"] == [0, 2, 3] and ids["ngram_jaccard"] == [0, 3]
    assert ids["personal_data"] == ids["best_fit_packing"] == [0, 3]
    clean = {r.doc_id: r for r in kept["personal_data"].collect()}
    assert clean[3].text == "unlike text mail [EMAIL]" and clean[3].n_chars == len(clean[3].text) and clean[0].text == base
    assert sorted(r.doc_id for r in corpus_pipeline.run(llm, str(tmp_path)).collect()) == [0, 3]


def test_pipeline_stages_on_odd_rows(llm):
    """Repeated and null ids, repeated rows, null texts, further columns with names used inside, and no rows at all."""
    import corpus_pipeline

    rnd = random.Random(5)
    words = [" ".join(f"{rnd.choice(['house', 'river', 'garden', 'winter', 'letter', 'music'])}{rnd.choice(['s', '', 'ly'])}" for _ in range(60)) for _ in range(6)]
    rows = [(1, words[0]), (5, words[0]), (5, words[1]), (None, words[2]), (None, words[2]), (7, words[3]), (7, words[3]), (8, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, __found int, n int"
    stages = dict(corpus_pipeline.STAGES)

    def run(stage, data):
        df = llm.createDataFrame([(i, t, "en", "s", 0, 3, 4) for i, t in data], schema).repartition(3)
        return sorted(((r[0], r[1]) for r in stages[stage](llm, df, "").collect()), key=str)

    assert run("exact_dedup", rows) == sorted({(1, words[0]), (5, words[1]), (None, words[2]), (7, words[3]), (8, None)}, key=str)
    near = [(1, words[4]), (2, words[4] + " more"), (3, words[5]), (5, words[4] + " last"), (5, words[1]), (None, words[4])]
    assert run("ngram_jaccard", near) == sorted([r for r in near if r[0] != 2], key=str)
    clean = run("personal_data", [*rows, (5, "mail x@y.org")])
    assert len(clean) == len(rows) + 1 and (5, "mail [EMAIL]") in clean and (5, words[1]) in clean and (8, None) in clean
    assert run("exact_dedup", []) == []


def test_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted({n.split("_")[0] for n in names}, key=lambda n: (len(n), n)) == [*(f"op{i}" for i in range(1, 10)), *(f"op{i}" for i in range(10, 14)), "pipeline"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
