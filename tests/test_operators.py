"""DataFrame operators on hand-made rows, their invariants and their plans."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from chartloom.operators.cohorts import categorize, cohort, matching, with_codes
from chartloom.operators.harmonize import harmonize
from chartloom.operators.keys import join_any_key, unpivot_keys
from chartloom.operators.lookups import lookup, lookup_chain, lookup_columns, normalize_codes, practice_location, prefer
from chartloom.operators.picks import down, first_per, rank_all, spread_top, up
from chartloom.operators.pivots import conditional_totals, elements_pivot, pivot_first
from chartloom.operators.privacy import deidentify, limited_dataset
from chartloom.operators.reports import qa_report
from chartloom.operators import skew
from chartloom.operators.skew import ranked
from chartloom.operators.surrogates import distinct_ids, extend_crosswalk, with_surrogates
from chartloom.operators.windows import within_window
from chartloom.sources.catalog import Catalog, table_sources
from chartloom.sources.sinks import ParquetSink, TableSink, stored

from plan_text import plan_of


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_window_includes_both_ends_at_midnight(rows):
    anchors = rows([("p", date(2020, 2, 29))], "k string, visit date")
    moments = [datetime(2018, 2, 28), datetime(2018, 2, 27, 23), datetime(2021, 2, 28), datetime(2021, 2, 28, 1)]
    records = rows([("p", m) for m in moments] + [("p", None)], "k string, at timestamp_ntz")
    got = within_window(anchors, records, "k", "visit", "at", "2 YEARS", "1 YEAR")
    assert {r["at"] for r in got.collect()} == {moments[0], moments[2]}


@pytest.mark.parametrize("before, after", [("2 DAYS", "1 DAY"), ("5 HOURS", None), (None, "40 DAYS")])
def test_window_join_equals_brute_force(rows, before, after):
    """One key holds most rows; time cells must neither lose nor repeat a pair."""
    rnd = random.Random(7)
    start = datetime(2019, 12, 25)

    def some(n):
        return [(i, "hot" if rnd.random() < 0.7 else f"k{rnd.randrange(5)}", start + timedelta(hours=rnd.randrange(24 * 90))) for i in range(n)]

    anchors, records = some(60), some(200)
    size = {None: timedelta(0), "2 DAYS": timedelta(days=2), "1 DAY": timedelta(days=1), "5 HOURS": timedelta(hours=5), "40 DAYS": timedelta(days=40)}
    expected = sorted((a[0], r[0]) for a in anchors for r in records if a[1] == r[1] and a[2] - size[before] <= r[2] <= a[2] + size[after])
    got = within_window(
        rows(anchors, "a int, k string, t timestamp_ntz"),
        rows(records, "r int, k string, u timestamp_ntz"),
        "k", "t", "u", before, after,
    )
    assert sorted((r.a, r.r) for r in got.collect()) == expected


def test_window_join_plan_is_an_equi_join(rows):
    anchors = rows([("p", date(2020, 1, 1))], "k string, d date")
    records = rows([("p", date(2020, 1, 1))], "k string, e date")
    assert "NestedLoop" not in plan_of(within_window(anchors, records, "k", "d", "e", "1 DAY", "1 DAY"))
    with pytest.raises(ValueError):
        within_window(anchors, anchors, "k", "d", "d", "1 DAY")


def test_window_join_holds_no_whole_side(rows):
    """Anchors repeat for every cell they visit, which no estimate tells."""
    anchors = rows([("a", "2020-01-01")], "k string, d string").withColumn("d", F.col("d").cast("date"))
    records = rows([("a", "2020-01-01", 1)], "k string, e string, n int").withColumn("e", F.col("e").cast("date"))
    found = within_window(anchors, records, "k", "d", "e", "1 DAY", "1 DAY")
    assert "SortMergeJoin" in plan_of(found) and "Broadcast" not in plan_of(found)
    assert found.count() == 1


@pytest.mark.parametrize("newest_first", [False, True])
@pytest.mark.parametrize("kind", ["date", "string", "timestamp_ntz", "decimal(9,2)"])
def test_ranks_equal_a_plain_numbering(rows, newest_first, kind):
    """A null key has most rows; null values, the text "none" and ties are ordered as in one window."""
    rnd = random.Random(3)
    values = {
        "date": [date(2020, 1, d) for d in range(1, 7)],
        "string": ["abc", "none", "zeta", "", "NULL"],
        "timestamp_ntz": [datetime(2020, 1, 1, h) for h in range(5)],
        "decimal(9,2)": [Decimal(n) / 4 for n in range(-3, 4)],
    }[kind]
    data = [(i, None if i % 3 else f"k{i % 4}", None if rnd.random() < 0.15 else rnd.choice(values)) for i in range(150)]
    df = rows(data, f"i int, k string, v {kind}")
    order = F.col("v").desc_nulls_first() if newest_first else F.col("v").asc_nulls_last()
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(order, "i")))
    assert found(rank_all(df, ["k"], "v", ["i"], newest_first)) == found(plain)
    assert found(ranked(df.limit(0), ["k"], "v", [up("i")])) == []


def test_one_key_and_one_date_spread_over_the_tasks_of_a_ranking(spark, rows, monkeypatch):
    """Half of the rows share key and date, a quarter is one row repeated; no task gets much more than its share."""
    held = {}
    monkeypatch.setattr(skew, "stored", lambda df: held.setdefault("rows", stored(df)))
    data = [(i, "k" if i % 2 else None, None if i % 2 else date(2020, 1, 1 + i % 9)) for i in range(3000)] + [(7, "z", None)] * 1000
    df = rows(data, "i int, k string, d date")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranks = sorted((r["k"] or "", r["rank"]) for r in ranked(df, ["k"], "d").collect())
        sizes = [r["count"] for r in held["rows"].groupBy(F.shiftright("_at", 33)).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ranks == [("", n + 1) for n in range(1500)] + [("k", n + 1) for n in range(1500)] + [("z", n + 1) for n in range(1000)]
    assert len(sizes) == 4 and max(sizes) < 1800


def test_a_ranking_reads_its_input_in_one_exchange(rows, monkeypatch):
    """Everything above the stored rows is one row per key and task, however the ranking is read."""
    plans = []
    monkeypatch.setattr(skew, "stored", lambda df: plans.append(plan_of(df)) or stored(df))
    ranked(rows([(1, "a", 2)], "i int, k string, v int"), ["k"], "v").collect()
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1 and "rangepartitioning" in plans[0]


def test_first_rows_and_null_order(rows):
    df = rows([("p", None, 1), ("p", date(2020, 1, 1), 2), ("p", date(2021, 1, 1), 3), ("q", date(2020, 1, 1), 9), ("q", date(2020, 1, 1), 4)], "k string, d date, i int")
    assert found(first_per(df, ["k"], [up("d"), up("i")]).select("k", "i")) == [("p", 2), ("q", 4)]
    assert found(first_per(df, ["k"], [down("d"), up("i")]).select("k", "i")) == [("p", 1), ("q", 4)]
    assert "WindowGroupLimit" in plan_of(first_per(df, ["k"], [up("d"), up("i")]))
    top = spread_top(first_per(df, ["k"], [up("d"), up("i")], n=2, rank="n"), ["k"], "n", {"i": "i{n}"}, 2)
    assert found(top) == [("p", 2, 3), ("q", 4, 9)]


def test_cohort_partitions_the_base(rows):
    base = rows([(i,) for i in range(10)] + [(None,)], "k int")
    yes, no = rows([(i,) for i in (1, 1, 2, 3)], "k int"), rows([(2,), (2,)], "k int")
    assert found(cohort(base, "k", include=[yes], exclude=[no])) == [(1,), (3,)]
    kept, dropped = cohort(base, "k", include=[no]), cohort(base, "k", exclude=[no])
    assert kept.count() + dropped.count() == base.count()


def test_any_key_join_counts_a_repeated_key_once(rows):
    left = rows([(1, "a", "a"), (2, "a", "b"), (3, "b", None), (4, None, None)], "i int, p string, s string")
    right = rows([("a", "x"), ("b", "y")], "key string, v string")
    joined = join_any_key(left, ["p", "s"], right, "key")
    assert sorted((r.i, r.v) for r in joined.collect()) == [(1, "x"), (2, "x"), (2, "y"), (3, "y")]
    assert "NestedLoop" not in plan_of(joined)


def test_unpivot_scans_once_and_drops_nulls(rows):
    df = rows([("p", "1", "1"), ("p", "2", None), ("p", "1", "1")], "g string, a string, b string")
    got = unpivot_keys(df, {"A": F.col("a"), "B": F.col("b")}, "key", "role", ["g"])
    assert found(got) == [("p", "1", "A"), ("p", "1", "B"), ("p", "2", "A")]


def test_code_lists(rows):
    df = rows([("a",), ("b",), ("z",), (None,)], "c string")
    assert found(with_codes(df, "c", {"a": "A", "b": "B"}, "n")) == [("a", "A"), ("b", "B")]
    assert found(with_codes(df, "c", ["z"])) == [("z",)]
    assert "Join" not in plan_of(with_codes(df, "c", {"a": "A"}, "n"))
    assert found(categorize(df, "c", {"early": ["a", "b"]}, "cat").select("c", "cat")) == [("a", "early"), ("b", "early")]


def test_text_rules_are_case_aware_and_drop_nulls(rows):
    df = rows([("patient declined",), ("Declined",), ("deferred",), (None,), ("Yes",)], "t string")
    assert found(matching(df, "t", exclude=["%declined%", "%deferred%"])) == [("Declined",), ("Yes",)]
    assert found(matching(df, "t", include=["%DECLINED%"])) == [("Declined",), ("patient declined",)]


def test_pivots(rows):
    df = rows([("p", "in", 3), ("p", "in", 1), ("p", "out", 9), ("q", "other", 1)], "k string, e string, t int")
    assert found(pivot_first(df, ["k"], "e", "t", {"in": "i", "out": "o"})) == [("p", 1, 9), ("q", None, None)]
    kv = rows([("p", "x", "1"), ("p", "y", "2"), ("p", "x2", "5")], "k string, e string, v string")
    got = elements_pivot(kv, ["k"], "e", "v", {"a": ["x", "x2"], "b": "y"}, cast={"a": lambda c: c.cast("int")})
    assert found(got) == [("p", 5, "2")]


def test_lookup_keeps_unmatched_and_repeats_matches(rows):
    df = rows([("a",), ("b",), (None,)], "c string")
    dim = rows([("a", "A1"), ("a", "A2")], "code string, name string")
    assert found(lookup(df, dim, {"c": "code"}, ["name"])) == [("a", "A1"), ("a", "A2"), ("b", None), (None, None)]


def test_lookup_chain_uses_the_first_table_that_knows(rows):
    df = rows([("1",), ("2",), ("3",), ("4",), (None,)], "c string")
    ten = rows([("1", "ten"), ("1", "ten too"), (None, "x")], "code string, name string")
    nine = rows([("1", "nine"), ("2", "nine")], "c9 string, n9 string")
    rest = rows([("2", "rest"), ("3", "rest")], "c0 string, n0 string")
    got = found(lookup_chain(df, {"c": "label"}, [ten, nine, rest]))
    assert set(got) == {("1", "ten"), ("1", "ten too"), ("2", "nine"), ("3", "rest"), ("4", None), (None, None)} and len(got) == 6
    assert len(found(lookup_chain(df, {"c": "label"}, [ten, nine, rest], dedupe=True))) == 5


def test_codes_without_dots(rows):
    df = rows([("C50",), ("174",), ("X",)], "raw string")
    first = rows([("C5.0", "a"), ("C5.0", "b")], "code string, name string")
    second = rows([("17.4", "c"), ("C.50", "d")], "code string, name string")
    assert found(normalize_codes(df, {"raw": "code"}, first, second)) == [("174", "17.4"), ("C50", "C5.0"), ("C50", "C5.0"), ("X", None)]
    assert len(found(normalize_codes(df, {"raw": "code"}, first, second, dedupe=True))) == 3


def test_many_code_columns_take_one_join(rows):
    """Every combination of values, as one left join per column gives; equal rows, null and unknown codes stay."""
    data = [("a", "b", "a"), ("a", "b", "a"), (None, "z", "b"), (None, None, None), ("c", "c", "c")]
    df = rows(data, "x string, y string, w string")
    dim = rows([("a", "A1"), ("a", "A2"), ("b", "B"), ("c", None), (None, "never"), ("d", "D")], "code string, name string")
    columns = {"x": "x_name", "y": "y_name", "w": "w_name"}
    one_by_one = df
    for c, n in columns.items():
        one_by_one = lookup(one_by_one, dim, {c: "code"}, {"name": n})
    melted = lookup_columns(df, dim, columns)
    joins = [line for line in plan_of(melted).splitlines() if "Join " in line]
    assert sum("_code" in j for j in joins) == 1
    assert found(melted) == found(one_by_one) and len(found(melted)) == 11 and melted.columns == one_by_one.columns
    assert found(lookup_columns(df.limit(0), dim, columns)) == [] and lookup_columns(df, dim, {}).columns == df.columns


def test_pivots_of_texts_aggregate_by_hash(rows):
    kv = rows([(None, "x", None), ("p", "x", "b"), ("p", "x", "a"), ("p", None, "q"), ("q", "y", "1")], "k string, e string, v string")
    out = elements_pivot(kv, ["k"], "e", "v", {"a": "x", "b": ["y", "z"]})
    assert found(out) == [("p", "b", None), ("q", None, "1"), (None, None, None)]
    doses = rows([("p", "i", Decimal("1.5"), "mg"), ("p", "i", Decimal("2"), "mL"), ("p", "j", None, None), (None, "k", Decimal("9"), "g")], "k string, i string, d decimal(9,2), u string")
    totals = conditional_totals(doses, ["k"], "i", F.col("d"), "u", {"i": "one", "j": "two"})
    assert found(totals) == [("p", Decimal("3.5"), "mg", Decimal(0), None), (None, Decimal(0), None, Decimal(0), None)]
    for df in (out, totals):
        assert "SortAggregate" not in plan_of(df) and "ObjectHashAggregate" in plan_of(df)


def test_source_preference_switches_everything(rows):
    df = rows([("r", None, "v", "w"), (None, "s", "v", "w")], "a string, b string, c string, d string")
    a, b, c, d = (F.col(x) for x in "abcd")
    chosen = df.select(prefer(a.isNotNull(), {"x": a, "y": b}, {"x": c, "y": d}, "s")).select("s.*")
    assert found(chosen) == [("r", None), ("v", "w")]


def test_practice_locations(rows):
    people = rows([("1",), ("2",), ("3",), (None,)], "prov string")
    inside = rows([("1", "Clinic")], "p string, loc string")
    outside = rows([("1", "Ext"), ("2", "Ext"), ("3", "")], "p string, name string")
    blank = [r[1:] for r in found(practice_location(people, "prov", inside, outside, blank_is_missing=True))]
    assert blank == [("Clinic", "Internal"), ("Ext", "External"), (None, "Unknown"), (None, "Unknown")]
    kept = {r[0]: r[1] for r in found(practice_location(people, "prov", inside, outside, blank_is_missing=False))}
    assert kept["3"] == ""


def test_privacy(rows):
    df = rows([("p", "Ann", datetime(2020, 1, 1, 8), "c1"), ("q", "Bob", datetime(2020, 1, 2), "c2")], "k string, name string, at timestamp_ntz, id string")
    walk = rows([("p", "S1", 10)], "k string, s string, move int")
    assert found(limited_dataset(df, walk, "k", "s", ["at"])) == [("S1", datetime(2020, 1, 1, 8))]
    numbers = extend_crosswalk(None, distinct_ids(df, {"id": "id"}))
    out = deidentify(df, walk, "k", "s", "move", ["at"], ["at"], {"id": "token"}, numbers)
    assert out.columns == ["s", "token", "at"]
    row = out.first()
    assert row["at"] == datetime(2020, 1, 11, 8) and row["token"] in (1, 2)
    with pytest.raises(ValueError):
        deidentify(df, walk, "k", "s", "move", ["at"], ["at"], {"id": "token"})
    nowhere = rows([("p", "S1", None)], "k string, s string, move int")
    assert found(deidentify(df, nowhere, "k", "s", "move", ["at"], ["at"])) == []


def test_surrogates_stay_over_refreshes(rows, tmp_path, spark):
    sink, walk = ParquetSink(spark, str(tmp_path)), {}
    known = None
    for n in (30, 30, 50):
        df = rows([(f"i{i}", f"j{i % 7}", None) for i in range(n)], "a string, b string, c string")
        known = sink.publish("walk", extend_crosswalk(known, distinct_ids(df, {"a": "case", "b": "log", "c": "log"})))
        now = {(r["kind"], r["id"]): r["number"] for r in known.collect()}
        assert walk.items() <= now.items()  # old numbers stay
        walk = now
        for kind, size in (("case", n), ("log", 7)):
            assert sorted(v for (k, _), v in now.items() if k == kind) == list(range(1, size + 1))
    assert [walk["case", f"i{i}"] for i in range(30)] != list(range(1, 31))  # in no order of the ids
    named = with_surrogates(rows([("i3", "j3"), ("i3", None), ("zz", "j1")], "a string, b string"), known, {"a": "case", "b": "log"}, {"a": "x", "b": "y"})
    assert found(named) == sorted([("i3", "j3", walk["case", "i3"], walk["log", "j3"]), ("i3", None, walk["case", "i3"], None), ("zz", "j1", None, walk["log", "j1"])], key=str)



def test_published_tables_are_found_again(spark, rows):
    """What one catalog publishes, a second one reads under the same name."""
    stages = {"analytics.n": lambda cat: cat["raw"].groupBy("k").count()}
    first = Catalog(spark, {"raw": lambda: rows([("a",), ("a",), ("b",)], "k string")}, stages)
    first.refresh(TableSink(spark, "default"), ["analytics.n"])
    try:
        second = Catalog(spark, table_sources(spark))
        assert found(second["analytics.n"]) == [("a", 2), ("b", 1)]
    finally:
        spark.sql("DROP DATABASE analytics CASCADE")


def test_report_matches_counts(rows):
    a, b = rows([(1,), (1,), (None,)], "k int"), rows([], "k int")
    assert found(qa_report({"b": b, "a": a}, distinct="k")) == [("a", 3, 1), ("b", 0, 0)]


def test_harmonized_key_and_types(rows):
    a, b = rows([("1", "x")], "id string, v string"), rows([(2, 5)], "id int, w int")
    got = harmonize({"A": (a, {"key": F.col("id"), "v": F.col("v")}), "B": (b, {"key": F.col("id"), "w": F.col("w")})}, {"key": "string", "v": "string", "w": "bigint"})
    assert found(got) == [("A", "1", "x", None), ("B", "2", None, 5)]
    with pytest.raises(ValueError):
        harmonize({"A": (a, {"other": F.col("id")})}, {"key": "string"})


def test_an_anchor_is_shuffled_for_few_cells(rows, monkeypatch):
    from chartloom.operators import windows

    seen, explode = [], F.explode
    monkeypatch.setattr(windows.F, "explode", lambda cells: seen.append(cells) or explode(cells))
    anchors = rows([("p", date(2000, 1, day)) for day in range(1, 29)], "k string, d date")
    records = rows([("p", date(2000, 1, day)) for day in range(1, 29)], "k string, e date")
    for spans, pairs in ((("1 DAY", None), 55), (("2 YEARS", "1 YEAR"), 28 * 28)):
        assert within_window(anchors, records, "k", "d", "e", *spans).count() == pairs
        assert anchors.select(F.max(F.size(seen.pop()))).first()[0] <= 3
