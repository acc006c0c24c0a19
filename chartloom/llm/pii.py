"""Personal data: fixed patterns, and identifiers found by contexts learned from them.

Everything is built-in column functions. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .shared import cut, stored

KINDS = ["email", "ip", "card", "phone"]

# Java patterns that match what the fixed definitions match, without retries at every letter:
# a run that fails from its first letter fails from any later one, except after another match (\G).
LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    # a whole run of digits with single separators, of 13 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What may be an identifier of a kind without meeting its definition.
LOOSE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){10,18}+(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9+(-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9-])",
}
CONTEXT = 64  # code points before a span in which its left words are sought
SPAN = "struct<kind:string,start:int,end:int,value:string,left:string>"
BLOCK = 64  # items that are walked at once
PART = 4096  # code points of the parts that a text is cut into before pieces of it are taken


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap necessary condition, so that most texts skip the pattern."""
    if kind == "email":
        return text.contains("@")
    return text.contains("+") if kind == "phone" else text.rlike("[0-9]")


def _may_hold_loose(kind: str, text: Column) -> Column:
    if kind == "email":
        return text.contains("@") | text.rlike(r"[(\[]at[)\]]")
    return text.contains(":") if kind == "ip" else text.rlike("[0-9]")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; named inside a lambda it would be computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _walk(items: Column, carry: Column, step: Callable[[Column, Column], tuple[Column, Column]], out: str) -> Column:
    """Array of what ``step(carry, item)`` puts out for each item in turn, next to the new carry.

    Spark copies the state of an aggregate at every step, so the state must stay small, however many
    items there are: one pass finds the carry at the start of each block, another the rows of each block.
    """
    none = F.array().cast(f"array<{out}>")

    def in_blocks(items: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(BLOCK))

        def block(at: Column) -> Column:
            return F.slice(items, at + 1, F.lit(BLOCK))

        def onward(carries: Column, at: Column) -> Column:
            last = F.aggregate(block(at), F.element_at(carries, -1), lambda c, item: step(c, item)[0])
            return F.concat(carries, F.array(last))

        def gathered(state: Column, item: Column) -> Column:
            after, made = step(state["carry"], item)
            return F.struct(after.alias("carry"), F.concat(state["rows"], F.array(made)).alias("rows"))

        def rows(carries: Column) -> Column:
            def of_block(at: Column, i: Column) -> Column:
                first = F.struct(F.get(carries, i).alias("carry"), none.alias("rows"))
                return F.aggregate(block(at), first, gathered, lambda s: s["rows"])

            return F.flatten(F.transform(starts, of_block))

        found = _once(F.aggregate(starts, F.array(carry), onward), rows)
        return F.when(F.size(items) > 0, found).otherwise(none)

    return _once(items, in_blocks)


def _last(text: Column) -> Column:
    return F.substring(text, -CONTEXT, CONTEXT)


def _spans(text: Column, kind: str, pattern: str, may: Column) -> Column:
    """Array of (kind, start, end, value, left) of the pattern's matches, from the pieces between them.

    left is the text before the match, up to ``CONTEXT`` code points.
    """

    def walked(found: Column, gaps: Column) -> Column:
        def step(carry: Column, i: Column) -> tuple[Column, Column]:
            gap, value = F.get(gaps, i), F.get(found, i)
            left = _last(F.concat(carry["left"], _last(gap)))
            start = carry["at"] + F.length(gap)
            end = start + F.length(value)
            one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"), left.alias("left"))
            return F.struct(end.alias("at"), _last(F.concat(left, value)).alias("left")), one

        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("left"))
        return _walk(F.sequence(F.lit(0), F.size(found) - 1), start, step, SPAN)

    def placed(found: Column) -> Column:
        spans = _once(F.split(text, pattern, -1), lambda gaps: walked(found, gaps))
        return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))

    return _once(F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: digits.substr(i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(each, F.lit(0), lambda total, d: total + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """What a match must meet beyond its pattern."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _holding(kind: str):
    return lambda s: _holds(kind, s["value"])


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def _by_start(a: Column, b: Column) -> Column:
    return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)


def base_spans(text: Column) -> Column:
    """Spans of the fixed definitions, by kind as listed, then by start."""
    found = []
    for kind in KINDS:
        spans = _spans(text, kind, BASE[kind], _may_hold(kind, text))
        found.append(F.filter(spans, _holding(kind)))
    return F.concat(*found)


def loose_spans(text: Column) -> Column:
    return F.concat(*[_spans(text, k, LOOSE[k], _may_hold_loose(k, text)) for k in KINDS])


def _apart(loose: Column, base: Column) -> Column:
    """The loose spans that overlap no base span, by one walk in each direction over all in order of their starts."""

    def marked(spans: Column, is_loose: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(is_loose).alias("loose"), s["end"].alias("end"), s.alias("span")))

    row = f"struct<start:int,loose:boolean,end:int,span:{SPAN},hit:boolean>"

    def walked(rows: Column, first: int, onward, meets) -> Column:
        def step(carry: Column, s: Column) -> tuple[Column, Column]:
            hit = s["hit"] | (s["loose"] & meets(carry, s))
            new = F.struct(*[s[c].alias(c) for c in ("start", "loose", "end", "span")], hit.alias("hit"))
            return F.when(s["loose"], carry).otherwise(onward(carry, s)), new

        return _walk(rows, F.lit(first), step, row)

    both = F.sort_array(F.concat(marked(loose, True), marked(base, False)))
    both = F.transform(both, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "loose", "end", "span")], F.lit(False).alias("hit")))
    # base spans that start no later, by the furthest end; then those that start later, by the nearest start
    ahead = walked(both, 0, lambda c, s: F.greatest(c, s["end"]), lambda c, s: s["start"] < c)
    back = walked(F.reverse(ahead), 2**31 - 1, lambda c, s: s["start"], lambda c, s: c < s["end"])
    free = F.transform(F.filter(back, lambda s: s["loose"] & ~s["hit"]), lambda s: s["span"])
    return F.when((F.size(loose) > 0) & (F.size(base) > 0), free).otherwise(loose)


def _with_cues(spans: Column) -> Column:
    """Spans with their cues: the word, and the two words, to the left, in lower case."""

    def one(s: Column) -> Column:
        left = F.lower(s["left"])
        cues = [F.regexp_extract(left, rf"({words})[\s\"'(]*$", 1) for words in (r"\S+\s+\S+", r"(?<!\S)\S+")]
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.array_remove(F.array(*cues), "").alias("cues"))

    return F.transform(spans, one)


def as_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def in_order(spans: Column) -> Column:
    """Spans by kind as listed, then by start."""
    return F.concat(*[F.array_sort(F.filter(spans, of_kind(k)), _by_start) for k in KINDS])


def learned_instances(edges: DataFrame, rounds: int, least_seeds: int, least_score: float) -> DataFrame:
    """(kind, value) of identifiers that are no seeds but score at least ``least_score``.

    ``edges`` has (cue, kind, value, seed). Cues and values form a bipartite graph that is scored in
    turns: a cue for a kind scores the sum of its values' scores of that kind over the number of all
    values after that cue, plus one; a value scores what its cues leave no doubt about, 1 - product
    of (1 - cue score). Seeds always score 1. A cue needs ``least_seeds`` different seeds. Counts are
    combined in the tasks first, so a cue or value that very many documents share is a row per task.
    """
    edges = cut(edges.groupBy("cue", "kind", "value").agg(F.max("seed").alias("seed")))
    cues = edges.groupBy("cue").agg(F.count("*").alias("all_values"))
    strong = edges.where("seed = 1").groupBy("cue", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= least_seeds)
    graph = cut(edges.join(strong.drop("seeds"), ["cue", "kind"]).join(cues, "cue"))
    scores = graph.select("kind", "value", F.col("seed").cast("double").alias("score")).distinct()
    for _ in range(rounds):
        known = graph.join(scores, ["kind", "value"])
        cue = known.groupBy("cue", "kind").agg((F.sum("score") / (F.max("all_values") + 1)).alias("cue_score"))
        doubt = F.sum(F.log(F.greatest(1 - F.col("cue_score"), F.lit(1e-9))))
        found = graph.join(cue, ["cue", "kind"]).groupBy("kind", "value").agg(doubt.alias("doubt"), F.max("seed").alias("seed"))
        scores = cut(found.select("kind", "value", F.when(F.col("seed") == 1, 1.0).otherwise(1 - F.exp("doubt")).alias("score")))
    seeds = edges.where("seed = 1").select("kind", "value").distinct()
    return scores.where(F.col("score") >= least_score).select("kind", "value").join(seeds, ["kind", "value"], "left_anti")


def personal_data(
    docs: DataFrame, id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), rounds: int = 3, least_seeds: int = 5, least_score: float = 0.8
) -> DataFrame:
    """One row per document: id, base and spans (arrays of kind, start, end), with the ``keep`` columns.

    base holds the matches of the fixed definitions. The one and two words before them become
    cues, cues and the values after them a graph (:func:`learned_instances`), and identifiers of a loose form that
    high-scoring cues introduce are added to spans, unless they overlap a base span.

    Null and empty texts have no spans. Rows that repeat an id are searched each. An empty table
    gives no rows. Clashing names of further columns do no harm, since only named ones are read.
    """
    body = F.coalesce(F.col("__text"), F.lit(""))
    rows = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"), F.struct(*[F.col(k) for k in keep] or [F.lit(None).cast("string").alias("none")]).alias("__kept"))
    rows = rows.withColumns({"base": base_spans(body), "loose": loose_spans(body)})
    rows = rows.withColumns({"base": _with_cues(F.col("base")), "loose": _with_cues(_apart(F.col("loose"), F.col("base")))})
    rows = stored(rows.drop("__text").withColumn("__row", F.monotonically_increasing_id()))
    both = [rows.select(F.explode(c).alias("s")).select(F.explode("s.cues").alias("cue"), "s.kind", "s.value", F.lit(seed).alias("seed")) for c, seed in (("base", 1), ("loose", 0))]
    learned = learned_instances(both[0].unionByName(both[1]), rounds, least_seeds, least_score)
    open_spans = rows.where("size(loose) > 0").select("__row", F.explode("loose").alias("s")).select("__row", "s.kind", "s.value", "s.start", "s.end")
    found = open_spans.join(learned, ["kind", "value"]).groupBy("__row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    slim = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = rows.select("__id", "__kept", "__row", slim.alias("base")).join(found, "__row", "left")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(in_order(F.concat("base", "more")))
    return rows.select(F.col("__id").alias(id), *[F.col(f"__kept.`{k}`").alias(k) for k in keep], "base", spans.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans only the first gets a name."""

    def rewritten(parts: Column, spans: Column) -> Column:
        def piece(a: Column, b: Column) -> Column:
            """The text from a to b, out of the parts that hold it."""
            first = F.floor(a / PART).cast("int")
            held = F.slice(parts, first + 1, F.floor((b - 1) / PART).cast("int") - first + 1)
            return F.when(a < b, F.array_join(held, "").substr(a % PART + 1, b - a)).otherwise("")

        def step(at: Column, s: Column) -> tuple[Column, Column]:
            new = F.concat(piece(at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.greatest(at, s["end"]), F.when(s["start"] >= at, new).otherwise("")

        walked = _walk(F.array_sort(spans, _by_start), F.lit(0), step, "string")
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(walked, ""), piece(end, F.length(text)))

    def named(spans: Column) -> Column:
        parts = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PART}}}+"), F.lit(0))
        return F.when(F.size(spans) > 0, _once(parts, lambda p: rewritten(p, spans))).otherwise(text)

    return _once(spans, named)
