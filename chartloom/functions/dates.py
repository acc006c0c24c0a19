"""Dates, intervals and ages."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, functions as F

EPOCH = "1840-12-31"  # fixed value: day zero of stored day counts, also the "no date" sentinel
AGE = "decimal(18,6)"
_UNIT_SECONDS = {"HOUR": 3600, "DAY": 86400, "MONTH": 31 * 86400, "YEAR": 366 * 86400}


@dataclass(frozen=True)
class DateShape:
    """One accepted spelling of a date: what the text looks like and how to read it."""

    regex: str
    pattern: str
    pad: int = 0


# Accepted spellings in the order in which they are tried.
ORDER_RESULT_DATES = (
    DateShape(r"^[0-9]{7,8}$", "MMddyyyy", pad=8),
    DateShape(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "y-M-d"),
    DateShape(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", "M/d/yy"),
    DateShape(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$", "M-d-yy"),
    DateShape(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2,4}$", "d-M-y"),
    DateShape(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}$", "M/d/y"),
)


def parse_dates(text: Column, shapes: Sequence[DateShape] = ORDER_RESULT_DATES) -> Column:
    """Read text by the first shape that matches; impossible dates are null.

    Two-digit years land within 1970-2069.
    """
    result = None
    for shape in shapes:
        source = F.lpad(text, shape.pad, "0") if shape.pad else text
        day = F.try_to_date(source, shape.pattern)
        if re.search(r"(?<!y)yy(?!y)", shape.pattern):
            day = F.when(F.year(day) > 2069, F.add_months(day, -1200)).otherwise(day)
        hit = text.rlike(shape.regex)
        result = F.when(hit, day) if result is None else result.when(hit, day)
    return result


def registry_date(text: Column, default_day: str = "01") -> Column:
    """Registry date of eight digits, or six completed with ``default_day``."""
    whole = F.when(text.rlike("^[0-9]{8}$"), text).when(
        text.rlike("^[0-9]{6}$"), F.concat(text, F.lit(default_day))
    )
    return F.try_to_date(whole, "yyyyMMdd")


def date_from_day_count(count: Column, epoch: str = EPOCH) -> Column:
    days = F.round(count.try_cast("decimal(38,9)"), 0).cast("int")
    return F.date_add(F.lit(epoch).cast("date"), days)


def null_if_sentinel(day: Column, sentinel: str = EPOCH) -> Column:
    return F.when(day.cast("date") == F.lit(sentinel).cast("date"), None).otherwise(day)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``."""
    return F.datediff(end.cast("date"), start.cast("date"))


def whole_days(start: Column, end: Column) -> Column:
    """Complete 24-hour days from ``start`` to ``end``."""
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), span).cast("int")


def age_in_years(days: Column) -> Column:
    return (days.cast("decimal(10,0)") / F.lit(Decimal("365.25"))).cast(AGE)


def shift(moment: Column, amount: str, sign: int = 1) -> Column:
    """Move a date or timestamp by a span such as "2 YEARS" or "48 HOURS"."""
    number, unit = _span(amount)
    step = F.expr(f"INTERVAL '{number}' {unit}")
    return moment + step if sign > 0 else moment - step


def span_seconds(amount: str) -> int:
    number, unit = _span(amount)
    return number * _UNIT_SECONDS[unit]


def _span(amount: str) -> tuple[int, str]:
    number, unit = amount.split()
    unit = unit.upper().rstrip("S")
    if unit not in _UNIT_SECONDS:
        raise ValueError(f"unknown time unit in {amount!r}")
    return int(number), unit


def epoch_seconds(moment: Column) -> Column:
    return F.unix_seconds(moment.cast("timestamp_ntz").cast("timestamp"))
