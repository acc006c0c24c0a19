"""Text, id and number columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

NUMBER = "decimal(38,9)"


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def to_number(value: Column) -> Column:
    """Number held as text; blank and malformed text become null instead of failing the job."""
    return blank_to_null(F.trim(value.cast("string"))).try_cast(NUMBER)


def is_rejected(value: Column) -> Column:
    """True for non-blank text that ``to_number`` could not read."""
    return blank_to_null(F.trim(value.cast("string"))).isNotNull() & to_number(value).isNull()


def canonical_id(value: Column) -> Column:
    """One spelling per numeric id ("012", "12.0" and 12 all become "12"); other text is trimmed."""
    text = F.trim(value.cast("string"))
    digits = F.regexp_extract(text, r"^0*([0-9]+)(?:\.0*)?$", 1)
    return F.when(digits != "", digits).otherwise(text)


def to_whole(value: Column) -> Column:
    """Number to integer, rounding halves away from zero."""
    return F.round(value.cast(NUMBER), 0).cast("int")


def by_prefix(value: Column, labels: Iterable[tuple[str, str]]) -> Column:
    """Replace a value by the label of the first prefix it starts with; others stay as they are."""
    result = value
    for prefix, label in reversed(list(labels)):
        result = F.when(value.startswith(prefix), F.lit(label)).otherwise(result)
    return result


def mapped(value: Column, labels: dict[str, str]) -> Column:
    """Code to label by a short fixed map; null for codes outside it."""
    result = None
    for code, label in labels.items():
        hit = value == F.lit(code)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result


def like_any(value: Column, patterns: Iterable[str], ignore_case: bool = False) -> Column:
    """Whether any LIKE pattern matches, from one reading of the text: all patterns are one expression.

    ``ignore_case`` compares lower-cased text and patterns, as ILIKE does. Null for a null text,
    false without patterns.
    """
    wanted = [_like_expression(p.lower() if ignore_case else p) for p in patterns]
    if not wanted:
        return F.when(value.isNotNull(), F.lit(False))
    return (F.lower(value) if ignore_case else value).rlike("(?s)" + "|".join(dict.fromkeys(wanted)))


def _like_expression(pattern: str) -> str:
    """A LIKE pattern as a regular expression to be found anywhere; ends without % are anchored."""
    parts, literal, at = [], "", 0
    while at < len(pattern):
        c = pattern[at]
        if c in "%_":
            parts.append(_quoted(literal) + (".*" if c == "%" else "."))
            literal = ""
        elif c == "\\":
            at += 1
            if at == len(pattern) or pattern[at] not in "%_\\":
                raise ValueError(f"a backslash must stand before %, _ or another one: {pattern}")
            literal += pattern[at]
        else:
            literal += c
        at += 1
    whole = "".join(parts) + _quoted(literal)
    whole = whole.removeprefix(".*") if pattern.startswith("%") else r"\A" + whole
    ends_open = parts and parts[-1].endswith(".*") and not literal
    return f"(?:{whole.removesuffix('.*') if ends_open else whole + chr(92) + 'z'})"


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() or c.isspace() else "\\" + c for c in literal)


def strip_dots(code: Column) -> Column:
    return F.replace(code, F.lit("."), F.lit(""))
