"""Column functions and the traps they guard against."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chartloom.functions.arrays import array_text, distinct_text, gather, ordered_array, ordered_text, pluck, rearrange
from chartloom.functions.dates import (
    age_in_years,
    date_from_day_count,
    days_between,
    null_if_sentinel,
    parse_dates,
    registry_date,
    shift,
    whole_days,
)
from chartloom.functions.text import like_any, blank_to_null, by_prefix, canonical_id, is_rejected, mapped, to_number, to_whole


def test_numbers_from_text(value):
    got = value(to_number, "12.5", " 7 ", "", "n/a", None, "0")
    assert got == [Decimal("12.5"), Decimal(7), None, None, None, Decimal(0)]
    assert value(is_rejected, "12.5", "", "n/a", None) == [False, False, True, False]


def test_rounding_to_whole(value):
    assert value(lambda x: to_whole(x.cast("decimal(18,6)")), "39.6", "14.5", "39.4", "-2.5") == [40, 15, 39, -3]


def test_canonical_ids(value):
    assert value(canonical_id, "012", "12.0", " 12 ", "A1", "0", "12.5", None) == ["12", "12", "12", "A1", "0", "12.5", None]


def test_prefix_order_and_maps(value):
    classes = [("IV", "IV"), ("III", "III"), ("II", "II"), ("I", "I")]
    assert value(lambda x: by_prefix(x, classes), "IV a", "III", "II-b", "I", "other", None) == ["IV", "III", "II", "I", "other", None]
    assert value(lambda x: mapped(x, {"0": "N", "1": "Y"}), "0", "1", "2", None) == ["N", "Y", None, None]
    assert value(blank_to_null, "", "a") == [None, "a"]


def test_date_spellings(value):
    texts = ["7232015", "07232015", "2015-7-23", "4/8/23", "04-18-23", "23-07-2015", "04-18-2015", "04/18/2015", "junk", None, "99999999"]
    assert value(parse_dates, *texts) == [
        date(2015, 7, 23), date(2015, 7, 23), date(2015, 7, 23), date(2023, 4, 8), date(2023, 4, 18), date(2015, 7, 23),
        None, date(2015, 4, 18), None, None, None,
    ]


def test_two_digit_years_land_near_2020(value):
    assert value(parse_dates, "1/2/95", "1-2-70", "1-2-69", "2/29/00") == [
        date(1995, 1, 2), date(1970, 1, 2), date(2069, 1, 2), date(2000, 2, 29)
    ]


def test_registry_dates(value):
    assert value(registry_date, "20150723", "201507", "bad", "20159999") == [date(2015, 7, 23), date(2015, 7, 1), None, None]
    assert value(lambda x: registry_date(x, "15"), "201507") == [date(2015, 7, 15)]


def test_day_counts_and_sentinel(value):
    assert value(date_from_day_count, "0", "63700.6", "x") == [date(1840, 12, 31), date(2015, 5, 29), None]
    assert value(lambda x: null_if_sentinel(x.cast("date")), "1840-12-31", "2020-01-01") == [None, date(2020, 1, 1)]


def test_day_differences(value):
    night = "2020-01-02 21:00:00"
    start = F.lit("2020-01-01 23:00:00")
    assert value(lambda x: days_between(start, x), night) == [1]
    assert value(lambda x: whole_days(start, x), night) == [0]
    assert value(lambda x: age_in_years(x.cast("int")), "14610") == [Decimal("40.000000")]


def test_calendar_shift(value):
    assert value(lambda x: shift(x.cast("date"), "2 YEARS", -1).cast("date"), "2020-02-29") == [date(2018, 2, 28)]
    assert value(lambda x: shift(x.cast("timestamp_ntz"), "48 HOURS", -1), "2020-03-01 06:00:00") == [datetime(2020, 2, 28, 6)]


def test_arrays_keep_nulls_and_order(rows):
    df = rows([("k", 2, None, "R"), ("k", 1, "a", "P"), ("k", None, "z", "P"), ("m", 1, None, None)], "g string, o int, v string, r string")
    order, v = [F.col("o")], F.col("v")
    got = {
        r.g: r
        for r in df.groupBy("g").agg(
            ordered_array(v, order).alias("all"),
            ordered_array(v, order, F.col("r") == "P").alias("p"),
            ordered_text(v, order, "; ").alias("t"),
            distinct_text(v, "|").alias("d"),
        ).collect()
    }
    assert got["k"].all == ["a", None, "z"] and got["k"].p == ["a", "z"] and got["k"].t == "a; z" and got["k"].d == "a|z"
    assert got["m"].all == [None] and got["m"].p is None and got["m"].t is None and got["m"].d is None


def test_gathered_rows_feed_several_arrays(rows):
    df = rows([(1, 3, "c", "B"), (1, 1, None, "B"), (1, 2, "b", None)], "g int, line int, name string, role string")
    fields = {"name": F.col("name"), "role": F.col("role"), "line": F.col("line")}
    once = df.groupBy("g").agg(gather([F.col("line")], fields).alias("s"))
    s = F.col("s")
    row = once.select(
        pluck(s, "name").alias("names"),
        pluck(rearrange(s, ["role", "line"]), "line").alias("by_role"),
        pluck(s, "name", lambda r: r["role"] == "X").alias("none"),
    ).first()
    assert row.names == [None, "b", "c"] and row.by_role == [1, 3, 2] and row.none is None


def test_array_text(rows):
    df = rows([(["a", "b c", None, "", "null", "x,y", 'q"\\', "{"],), (None,), ([],)], "a array<string>")
    assert [r[0] for r in df.select(array_text(F.col("a"))).collect()] == [
        '{a,"b c",NULL,"","null","x,y","q\\"\\\\","{"}', None, "{}"
    ]


PATTERNS = ["%ab%", "ab%", "%ab", "a_b", "%a%b%", "_", "%", "", "a.b%", "%(x|y)%", "%50\\%%", "a\\_b", "%\n%", "%é%", "A%Z", "%_x", "x_%"]


@pytest.mark.parametrize("ignore_case", [False, True])
def test_one_expression_matches_like_the_patterns(spark, ignore_case):
    """Each pattern alone, and all pairs of them, as LIKE and ILIKE decide."""
    texts = ["", "a", "ab", "xaby", "a.b!", "AxB", "a\nb", "(x|y)", "50%", "a_b", "É", "éz", "AZ", "AbZ\n", "ab\n", None, "x", "xx", "yx\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    text = F.col("t")
    plain = [text.ilike(p) if ignore_case else text.like(p) for p in PATTERNS]
    pairs = [(i, (i * 7 + 3) % len(PATTERNS)) for i in range(len(PATTERNS))]
    one = [like_any(text, [p], ignore_case).alias(f"o{i}") for i, p in enumerate(PATTERNS)] + [like_any(text, [PATTERNS[i], PATTERNS[j]], ignore_case).alias(f"p{i}") for i, j in pairs]
    two = [p.alias(f"o{i}") for i, p in enumerate(plain)] + [(plain[i] | plain[j]).alias(f"p{i}") for i, j in pairs]
    assert df.select("t", *one).collect() == df.select("t", *two).collect()
    assert [r[0] for r in df.select(like_any(text, [])).distinct().collect()].count(False) == 1
