"""URL verdicts by rules and, where no rule fits, by a tree of path templates per host."""

from __future__ import annotations

import dataclasses
import itertools
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .shared import cut

SALTS = 16
MARK = "\u0001"  # leads the wildcards in node names, so that no segment of a url looks like one


@dataclasses.dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty if it is null or has no ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct (size, name, verdict) of the longest rule that fits, or null; of equally long ones the last by name."""
    found = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    nothing = F.lit(None).cast("struct<size:int,name:string,verdict:string>")
    return F.greatest(nothing, nothing, *found) if found else nothing


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule], id: str = "page_id", url: str = "url",
    variable_values: int = 8, variable_share: float = 0.5, similar_z: float = 1.96, prior_weight: float = 4.0, reject_at: float = 0.7,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template, purity.

    Pages that a rule decides are the labelled ones. Level by level, from the host down, the
    segments below each node become its branches:

    * segments that differ in their numbers only become one wildcard branch where at least
      ``variable_values`` of them occur, and all segments do where most values (``variable_share``
      of the rows) are distinct;
    * branches whose share of blocked labels does not differ from their node's, by a z-test of
      proportions at ``similar_z``, are merged; so are those without labels;
    * the purity of a branch is its share of blocked labels, smoothed towards the purity of the
      node above with the weight of ``prior_weight`` labels, and at the root towards that of all.

    A page without a rule is blocked if the purity of its template is at least ``reject_at``.
    Levels go down to the end of the longest path. All counts cover all pages.

    Null urls and those without ``://`` have an empty host and path and share one template. Rows
    that repeat an id are judged each. An empty table gives no rows.
    """
    host, path = host_and_path(url)
    rows = pages.select(F.col(id).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", matching_rule(rules, F.col("host"), F.col("path")))
    inner = F.regexp_replace("path", "^/", "")
    segments = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "/", -1))
    rows = rows.select(
        "id", "host", "path", "hit", segments.alias("segments"), F.col("host").alias("node"),
        F.when(F.col("hit").isNull(), 0).otherwise(1).alias("labelled"),
        F.when(F.col("hit.verdict") == "block", 1).otherwise(0).alias("blocked"),
    )
    rows = cut(rows)

    def smoothed(above: Column) -> Column:
        return (F.col("blocked") + prior_weight * above) / (F.col("labelled") + prior_weight)

    totals = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    whole = rows.agg(*totals).first()
    prior = (whole["blocked"] or 0) / whole["labelled"] if whole["labelled"] else 0.0
    roots = rows.groupBy("node").agg(*totals).select("node", smoothed(F.lit(prior)).alias("purity"))
    rows = _salted_join(rows, roots, ["node"])
    finished = []
    for level in itertools.count():
        rows = cut(rows.withColumn("segment", F.get("segments", F.lit(level))))
        finished.append(rows.where("segment IS NULL").drop("segment"))
        rows = rows.where("segment IS NOT NULL")
        if rows.isEmpty():
            break
        rows = _descend(rows, totals, smoothed, variable_values, variable_share, similar_z)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    verdict = F.coalesce("hit.verdict", F.when(F.col("purity") >= reject_at, "block").otherwise("allow"))
    template = F.translate("node", MARK, "")
    return out.select(F.col("id").alias(id), "host", "path", F.col("hit.name").alias("rule"), verdict.alias("verdict"), template.alias("template"), "purity")


def _salted_join(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with a side of one row per key, which is repeated so that a hot host spreads over ``SALTS`` tasks."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int"))
    many = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(many, [*keys, "salt"]).drop("salt")


def _descend(rows, totals, smoothed, variable_values: int, variable_share: float, similar_z: float) -> DataFrame:
    """``rows`` moved to the branch that their segment belongs to."""
    kids = rows.groupBy("node", "segment").agg(*totals, F.count("*").alias("n"), F.first("purity").alias("above"))
    kids = kids.withColumn("shape", F.regexp_replace("segment", "[0-9]+", f"{MARK}*"))
    shapes = kids.groupBy("node", "shape").agg(F.count("*").alias("values"))
    nodes = kids.groupBy("node").agg(
        F.count("*").alias("node_values"), F.sum("n").alias("node_n"),
        F.sum("labelled").alias("node_labelled"), F.sum("blocked").alias("node_blocked"),
    )
    kids = kids.join(shapes, ["node", "shape"]).join(nodes, "node")
    share = F.col("node_blocked") / F.greatest("node_labelled", F.lit(1))
    off = F.abs(F.col("blocked") - F.col("labelled") * share)
    similar = off <= similar_z * F.sqrt(F.col("labelled") * share * (1 - share)) + 1e-9
    branch = (
        F.when((F.col("shape") != F.col("segment")) & (F.col("values") >= variable_values), F.col("shape"))
        .when((F.col("node_values") >= variable_values) & (F.col("node_values") > variable_share * F.col("node_n")), f"{MARK}*")
        .when(similar, f"{MARK}~")
        .otherwise(F.col("segment"))
    )
    kids = kids.withColumn("branch", branch)
    branches = kids.groupBy("node", "branch").agg(*totals, F.first("above").alias("above"))
    branches = branches.select("node", "branch", smoothed(F.col("above")).alias("purity"))
    to = kids.join(branches, ["node", "branch"]).select("node", "segment", "branch", F.col("purity").alias("down"))
    moved = _salted_join(rows, to, ["node", "segment"])
    return moved.select(*[c for c in rows.columns if c not in ("node", "purity", "segment")], F.concat_ws("/", "node", "branch").alias("node"), F.col("down").alias("purity"))
