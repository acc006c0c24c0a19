"""One query per operator family, mapped onto the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.functions.arrays import array_text, distinct_text, ordered_array, ordered_text
from chartloom.functions.dates import (
    age_in_years,
    date_from_day_count,
    days_between,
    null_if_sentinel,
    parse_dates,
    shift,
    whole_days,
)
from chartloom.functions.text import blank_to_null, by_prefix, is_rejected, mapped, strip_dots, to_number, to_whole
from chartloom.operators.cohorts import categorize, cohort, inline_rows, matching, with_codes
from chartloom.operators.harmonize import harmonize
from chartloom.operators.keys import join_any_key, unpivot_keys
from chartloom.operators.lookups import lookup, lookup_chain, normalize_codes, practice_location, prefer
from chartloom.operators.picks import down, first_per, rank_all, spread_top, up
from chartloom.operators.skew import ranked
from chartloom.operators.pivots import conditional_totals, elements_pivot, pivot_first
from chartloom.operators.privacy import deidentify, limited_dataset
from chartloom.operators.reports import days_from, qa_report
from chartloom.operators.surrogates import distinct_ids, extend_crosswalk
from chartloom.operators.windows import within_window
from chartloom.sources.catalog import Catalog
from chartloom.sources.sinks import TableSink, ViewSink, shared_workspace

from .base import check, role_frame
from .datasets import element
from .roles_oncology import DATE_TEXT

col, lit = F.col, F.lit


def order_day():
    return col("o_orderdate").cast("date")


def text(column: str):
    return col(column).cast("string")


def money(column: str):
    return col(column).cast("decimal(18,4)")


# ------------------------------------------------------------------ sources, sinks


@check("table_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t):
    return t.nation.select("n_nationkey", "n_name", "n_regionkey")


@check(
    "inline_rows",
    """SELECT o_orderkey, o_orderpriority, grade FROM orders
       JOIN (VALUES ('1-URGENT', 'high'), ('2-HIGH', 'high'), ('5-LOW', 'low')) v(p, grade) ON p = o_orderpriority""",
)
def _(t):
    grades = inline_rows(t.orders, [("1-URGENT", "high"), ("2-HIGH", "high"), ("5-LOW", "low")], "o_orderpriority string, grade string")
    return t.orders.join(F.broadcast(grades), "o_orderpriority").select("o_orderkey", "o_orderpriority", "grade")


@check("refreshed_output", "SELECT o_custkey, count(*) AS n_orders, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1")
def _(t):
    sink = TableSink(t.spark, root=shared_workspace(t.spark).root)
    sink.publish("checks.orders_by_customer", t.orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderdate"))
    old = t.spark.table("checks.orders_by_customer")  # the refresh reads the version that it replaces
    every = old.unionByName(t.orders.where("NOT o_orderstatus <=> 'F'").select("o_custkey", "o_orderdate"))
    sink.publish("checks.orders_by_customer", every.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max(order_day()).alias("last_day")))
    return t.spark.table("checks.orders_by_customer")


@check("session_dataset", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1")
def _(t):
    ViewSink().publish("temp.urgent_orders", t.orders.where("o_orderpriority = '1-URGENT'"))
    return t.spark.sql("SELECT o_orderstatus, count(*) AS n FROM temp_urgent_orders GROUP BY o_orderstatus")


@check(
    "stage_reuse",
    """WITH busy AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12)
       SELECT c.c_mktsegment, count(*) AS customers, CAST(sum(n) AS BIGINT) AS orders FROM busy JOIN customer c ON c.c_custkey = o_custkey GROUP BY 1""",
)
def _(t):
    stages = {
        "busy": lambda cat: cat["orders"].groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 12"),
        "by_segment": lambda cat: cat["busy"]
        .join(cat["customer"], col("o_custkey") == col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("customers"), F.sum("n").alias("orders")),
    }
    return Catalog(t.spark, {"orders": lambda: t.orders, "customer": lambda: t.customer}, stages)["by_segment"]


# ------------------------------------------------------------------ projection, filters


@check(
    "projection_labels",
    """SELECT s_suppkey AS provider_id, s_name AS provider_name, 'Internal' AS loc_type, CAST(NULL AS VARCHAR) AS comment FROM supplier""",
)
def _(t):
    return t.supplier.select(
        col("s_suppkey").alias("provider_id"), col("s_name").alias("provider_name"),
        lit("Internal").alias("loc_type"), lit(None).cast("string").alias("comment"),
    )


@check("star_expansion", "SELECT n.*, r_name, n.n_nationkey + 1 AS next_key FROM nation n JOIN region ON r_regionkey = n_regionkey")
def _(t):
    joined = t.nation.alias("n").join(t.region, col("r_regionkey") == col("n_regionkey"))
    return joined.select("n.*", "r_name", (col("n_nationkey") + 1).alias("next_key"))


@check(
    "filter_predicates",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus <> 'F' AND l_quantity > 10 AND l_linenumber >= 2 AND l_discount < 0.05
         AND l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31' AND (l_partkey % 2 = 0 OR l_suppkey % 3 = 0)""",
)
def _(t):
    low, high = lit("1997-01-01").cast("timestamp_ntz"), lit("1998-12-31").cast("timestamp_ntz")
    return t.lineitem.where(
        (col("l_returnflag") == "R") & (col("l_linestatus") != "F") & (col("l_quantity") > 10) & (col("l_linenumber") >= 2)
        & (col("l_discount") < 0.05) & col("l_shipdate").between(low, high) & ((col("l_partkey") % 2 == 0) | (col("l_suppkey") % 3 == 0))
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@check(
    "code_membership",
    "SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL', 'LARGE') AND p_brand NOT IN ('Brand#1', 'Brand#2')",
)
def _(t):
    kept = with_codes(t.part, "p_type", ["PROMO", "SMALL", "LARGE"])
    return kept.where(~col("p_brand").isin("Brand#1", "Brand#2")).select("p_partkey", "p_type")


@check(
    "null_safe_filters",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
       WHERE l.quality IS DISTINCT FROM 1 AND d.lang IS NOT NULL AND (l.toxic IS NULL OR l.toxic = 0)""",
)
def _(t):
    known = lookup(t.documents.select("doc_id", "lang"), t.labels, "doc_id", ["quality", "toxic"])
    kept = ~col("quality").eqNullSafe(1) & col("lang").isNotNull() & (col("toxic").isNull() | (col("toxic") == 0))
    return known.where(kept).select("doc_id", "quality")


@check(
    "text_patterns",
    r"""SELECT doc_id FROM documents WHERE text LIKE '%the%' AND text NOT LIKE '%The%' AND lower(text) LIKE '%and%'
        AND regexp_matches(text, '[0-9]{2}')""",
)
def _(t):
    body = col("text")
    return t.documents.where(
        body.like("%the%") & ~body.like("%The%") & body.ilike("%AND%") & body.rlike("[0-9]{2}")
    ).select("doc_id")


@check(
    "case_expressions",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END AS without_else,
       CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderpriority LIKE '1%' THEN 'a' ELSE 'b' END ELSE 'c' END AS nested FROM orders""",
)
def _(t):
    urgent = F.when(col("o_orderpriority").like("1%"), "a").otherwise("b")
    return t.orders.select(
        "o_orderkey",
        mapped(col("o_orderstatus"), {"F": "done", "O": "open"}).alias("without_else"),
        F.when(col("o_orderstatus") == "F", urgent).otherwise("c").alias("nested"),
    )


@check("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@check(
    "identifier_suppression",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 9 < 2 THEN NULL ELSE s_name END AS provider,
       CASE WHEN s_suppkey % 9 < 2 THEN 'Unknown' ELSE 'Known' END AS status FROM supplier""",
)
def _(t):
    listed = (col("s_suppkey") % 9).isin(0, 1)
    return t.supplier.select(
        "s_suppkey", F.when(~listed, col("s_name")).alias("provider"), F.when(listed, "Unknown").otherwise("Known").alias("status")
    )


# ------------------------------------------------------------------ joins


@check(
    "inner_equi_join",
    "SELECT o_orderkey, c_mktsegment, l_linenumber, l_partkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey",
)
def _(t):
    lines = t.lineitem.select(col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    people = t.customer.select(col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.join(people, "o_custkey").join(lines, "o_orderkey").select("o_orderkey", "c_mktsegment", "l_linenumber", "l_partkey")


@check(
    "left_lookup",
    """SELECT l_orderkey, l_linenumber, p_name, r_name FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 20) p ON p_partkey = l_partkey
       LEFT JOIN region ON r_regionkey = l_suppkey""",
)
def _(t):
    named = lookup(t.lineitem, t.part.where("p_size <= 20"), {"l_partkey": "p_partkey"}, ["p_name"])
    return lookup(named, t.region, {"l_suppkey": "r_regionkey"}, ["r_name"]).select("l_orderkey", "l_linenumber", "p_name", "r_name")


@check(
    "left_join_ranked_side",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) o
       ON o_custkey = c_custkey AND rn = 1""",
)
def _(t):
    first = first_per(t.orders, ["o_custkey"], [up("o_orderdate"), up("o_orderkey")])
    return lookup(t.customer, first, {"c_custkey": "o_custkey"}, ["o_orderkey"]).select("c_custkey", "o_orderkey")


@check(
    "type_reconciled_join",
    "SELECT o_orderkey, n_name FROM orders JOIN nation ON CAST(n_nationkey AS VARCHAR) = CAST(o_custkey AS VARCHAR)",
)
def _(t):
    nations = t.nation.select(text("n_nationkey").alias("key"), "n_name")
    return t.orders.select("o_orderkey", text("o_custkey").alias("key")).join(nations, "key").select("o_orderkey", "n_name")


@check(
    "any_key_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, k, tag FROM lineitem
       JOIN (SELECT n_nationkey * 3 AS k, n_name AS tag FROM nation) n ON k = l_partkey OR k = l_suppkey""",
)
def _(t):
    keys = t.nation.select((col("n_nationkey") * 3).cast("long").alias("k"), col("n_name").alias("tag"))
    joined = join_any_key(t.lineitem, ["l_partkey", "l_suppkey"], keys, "k")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", col("k").cast("int").alias("k"), "tag")


@check(
    "expression_key_join",
    """SELECT d.doc_id, n_name FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN nation ON n_nationkey = coalesce(l.quality, d.doc_id % 25)""",
)
def _(t):
    keyed = lookup(t.documents.select("doc_id"), t.labels, "doc_id", ["quality"])
    keyed = keyed.withColumn("k", F.coalesce(col("quality").cast("long"), col("doc_id") % 25))
    return lookup(keyed, t.nation, {"k": "n_nationkey"}, ["n_name"]).select("doc_id", "n_name")


_pairs = """SELECT a.o_custkey, a.o_orderkey AS anchor_key, b.o_orderkey AS record_key, CAST(b.o_orderdate AS DATE) AS record_day FROM orders a
  JOIN orders b ON b.o_custkey = a.o_custkey WHERE CAST(b.o_orderdate AS DATE) >= CAST(a.o_orderdate AS DATE) - INTERVAL 2 YEAR
  AND CAST(b.o_orderdate AS DATE) <= CAST(a.o_orderdate AS DATE) + INTERVAL 1 YEAR"""


@check("temporal_window_join", _pairs)
def _(t):
    anchors = t.orders.select("o_custkey", col("o_orderkey").alias("anchor_key"), order_day().alias("anchor_day"))
    records = t.orders.select("o_custkey", col("o_orderkey").alias("record_key"), order_day().alias("record_day"))
    return within_window(anchors, records, "o_custkey", "anchor_day", "record_day", "2 YEARS", "1 YEAR").drop("anchor_day")


_busy_pairs = """SELECT a.l_orderkey AS anchor_order, a.l_linenumber AS anchor_line, b.o_orderkey AS record_key
FROM (SELECT *, CASE WHEN l_linenumber < 4 THEN 0 ELSE l_suppkey END AS party FROM lineitem WHERE l_shipdate IS NOT NULL) a
JOIN (SELECT *, CASE WHEN o_orderpriority < '3' THEN 0 ELSE o_custkey END AS party FROM orders) b ON a.party = b.party
  AND CAST(b.o_orderdate AS DATE) >= CAST(a.l_shipdate AS DATE) - INTERVAL 1 DAY AND CAST(b.o_orderdate AS DATE) <= CAST(a.l_shipdate AS DATE)"""


@check("temporal_window_join_hot_keys", _busy_pairs)
def _(t):
    """One party has more than a third of the rows on both sides."""
    line = t.lineitem.select(
        F.when(col("l_linenumber") < 4, 0).otherwise(col("l_suppkey")).alias("party"), col("l_orderkey").alias("anchor_order"),
        col("l_linenumber").alias("anchor_line"), col("l_shipdate").cast("date").alias("anchor_day"),
    )
    order = t.orders.select(
        F.when(col("o_orderpriority") < "3", 0).otherwise(col("o_custkey")).alias("party"), col("o_orderkey").alias("record_key"), order_day().alias("record_day")
    )
    return within_window(line, order, "party", "anchor_day", "record_day", "1 DAY").select("anchor_order", "anchor_line", "record_key")


@check("semi_join", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(col("o_custkey").alias("c_custkey"))
    return cohort(t.customer, "c_custkey", include=[urgent]).select("c_custkey")


@check("anti_join", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(col("o_custkey").alias("c_custkey"))
    return cohort(t.customer, "c_custkey", exclude=[urgent]).select("c_custkey")


@check(
    "include_exclude_cohort",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
       WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'PROMO')
         AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'SMALL')""",
)
def _(t):
    typed = t.lineitem.join(t.part.select(col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")

    def having(kind):
        return typed.where(col("p_type") == kind).select(col("l_orderkey").alias("o_orderkey")).distinct()

    return cohort(t.orders, "o_orderkey", [having("PROMO")], [having("SMALL")]).select("o_orderkey", "o_custkey", "o_orderdate")


@check(
    "not_covered_rows",
    "SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR nullif(l.toxic, 1) IS NULL",
)
def _(t):
    fine = t.labels.groupBy("doc_id").agg(F.max(F.nullif("toxic", lit(1)).isNull()).alias("open")).where("NOT open")
    return cohort(t.documents, "doc_id", exclude=[fine]).select("doc_id")


@check(
    "outer_made_inner",
    "SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey < 12 WHERE n_name <> 'NATION_3'",
)
def _(t):
    wanted = t.nation.where((col("n_nationkey") < 12) & (col("n_name") != "NATION_3"))
    return t.supplier.join(wanted, col("n_nationkey") == col("s_nationkey")).select("s_suppkey", "n_name")


@check(
    "same_dimension_twice",
    """SELECT l_orderkey, l_linenumber, a.n_name AS supplier_nation, b.n_name AS line_nation FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
       LEFT JOIN nation a ON a.n_nationkey = s_nationkey LEFT JOIN nation b ON b.n_nationkey = l_linenumber""",
)
def _(t):
    lines = t.lineitem.join(t.supplier.select(col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    lines = lookup(lines, t.nation, {"s_nationkey": "n_nationkey"}, {"n_name": "supplier_nation"})
    lines = lookup(lines, t.nation, {"l_linenumber": "n_nationkey"}, {"n_name": "line_nation"})
    return lines.select("l_orderkey", "l_linenumber", "supplier_nation", "line_nation")


@check(
    "correlated_aggregates",
    """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS done,
       (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O') AS open,
       (SELECT string_agg(o_orderpriority, ';' ORDER BY o_orderpriority) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O') AS open_priorities
       FROM customer""",
)
def _(t):
    status, priority = col("o_orderstatus"), col("o_orderpriority")
    counts = t.orders.groupBy("o_custkey").agg(
        F.count_if(status == "F").alias("done"),
        F.count_if(status == "O").alias("open"),
        ordered_text(priority, [priority], ";", status == "O").alias("open_priorities"),
    )
    names = ["done", "open", "open_priorities"]
    return lookup(t.customer, counts, {"c_custkey": "o_custkey"}, names).select(
        "c_custkey", F.coalesce("done", lit(0)).alias("done"), F.coalesce("open", lit(0)).alias("open"), "open_priorities"
    )


@check(
    "code_list_join",
    "SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'fault' ELSE 'trade' END AS family FROM events WHERE event_type IN ('error', 'purchase')",
)
def _(t):
    return with_codes(t.events, "event_type", {"error": "fault", "purchase": "trade"}, "family").select("event_id", "event_type", "family")


# ------------------------------------------------------------------ aggregation


@check(
    "first_last_dates",
    "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day, count(*) AS n FROM orders GROUP BY 1",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.min(order_day()).alias("first_day"), F.max(order_day()).alias("last_day"), F.count("*").alias("n"))


@check(
    "qa_report",
    """SELECT 'Customers' AS dataset, count(*) AS record_count, count(DISTINCT k) AS distinct_case_count FROM (SELECT c_nationkey AS k FROM customer)
       UNION ALL SELECT 'Lines', count(*), count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT 'Orders', count(*), count(DISTINCT o_custkey) FROM orders""",
)
def _(t):
    return qa_report(
        {
            "Customers": t.customer.select(col("c_nationkey").alias("k")),
            "Orders": t.orders.select(col("o_custkey").alias("k")),
            "Lines": t.lineitem.select(col("l_orderkey").alias("k")),
        },
        distinct="k",
    )


@check(
    "studies_by_category",
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS total, count(DISTINCT o_orderpriority) FILTER (WHERE o_orderstatus = 'F') AS done,
       count(DISTINCT o_orderpriority) FILTER (WHERE o_orderstatus = 'O') AS open FROM orders GROUP BY 1""",
)
def _(t):
    """Pairs are made distinct first, so every count runs over a handful of rows per customer."""
    pairs = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.max(col("o_orderstatus") == "F").alias("f"), F.max(col("o_orderstatus") == "O").alias("o")
    )
    return pairs.groupBy("o_custkey").agg(
        F.count("o_orderpriority").alias("total"), F.count_if("f").alias("done"), F.count_if("o").alias("open")
    )


_stems = {"PROMO": "promo", "SMALL": "small", "LARGE": "large"}


@check(
    "conditional_totals",
    "SELECT l_orderkey, "
    + ", ".join(
        f"CAST(sum(CASE WHEN p_type = '{k}' THEN CAST(l_quantity AS DECIMAL(18,4)) ELSE 0 END) AS DECIMAL(38,9)) AS {s}_total_dose,"
        f" max(CASE WHEN p_type = '{k}' THEN l_returnflag END) AS {s}_dose_unit"
        for k, s in _stems.items()
    )
    + " FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1",
)
def _(t):
    typed = t.lineitem.join(t.part.select(col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    return conditional_totals(typed, ["l_orderkey"], "p_type", money("l_quantity"), "l_returnflag", _stems)


@check(
    "event_pivot",
    """SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS first_signup, min(ts) FILTER (WHERE event_type = 'purchase') AS first_purchase,
       min(CASE WHEN event_type = 'error' THEN ts END) AS first_error FROM events GROUP BY 1""",
)
def _(t):
    return pivot_first(
        t.events, ["user_id"], "event_type", "ts", {"signup": "first_signup", "purchase": "first_purchase", "error": "first_error"}
    )


@check(
    "ordered_text",
    "SELECT l_orderkey, string_agg(s_name, '; ' ORDER BY l_linenumber, s_name) AS names FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 2000 GROUP BY 1",
)
def _(t):
    named = lookup(t.lineitem, t.supplier.where("s_acctbal > 2000"), {"l_suppkey": "s_suppkey"}, ["s_name"])
    return named.groupBy("l_orderkey").agg(ordered_text(col("s_name"), [col("l_linenumber"), col("s_name")], "; ").alias("names"))


@check(
    "string_agg_distinct",
    """SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS priorities,
       string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) FILTER (WHERE o_orderstatus = 'F') AS done_priorities FROM orders GROUP BY 1""",
)
def _(t):
    priority = col("o_orderpriority")
    return t.orders.groupBy("o_custkey").agg(
        distinct_text(priority, " | ").alias("priorities"),
        distinct_text(priority, " | ", col("o_orderstatus") == "F").alias("done_priorities"),
    )


_order = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"


def _rendered(value: str, where: str = "") -> str:
    keep = f" FILTER (WHERE {where})" if where else ""
    return f"'{{' || string_agg({element(value)}, ',' ORDER BY {_order}){keep} || '}}'"


@check(
    "ordered_arrays",
    f"""SELECT l_orderkey, {_rendered('s_name')} AS all_names, {_rendered('s_name', "l_returnflag = 'R'")} AS returned_names
        FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 2000 GROUP BY 1""",
)
def _(t):
    named = lookup(t.lineitem, t.supplier.where("s_acctbal > 2000"), {"l_suppkey": "s_suppkey"}, ["s_name"])
    order = [col(c.strip()) for c in _order.split(",")]
    return named.groupBy("l_orderkey").agg(
        array_text(ordered_array(col("s_name"), order)).alias("all_names"),
        array_text(ordered_array(col("s_name"), order, col("l_returnflag") == "R")).alias("returned_names"),
    )


_styled = """CASE l_suppkey % 6 WHEN 0 THEN 'two words' WHEN 1 THEN 'a,b' WHEN 2 THEN 'say "x"' WHEN 3 THEN '' WHEN 4 THEN 'null' ELSE 'plain' END"""


@check(
    "array_text",
    f"SELECT l_orderkey, {_rendered('v')} AS rendered FROM (SELECT *, {_styled} AS v FROM lineitem) GROUP BY 1",
)
def _(t):
    order = [col(c.strip()) for c in _order.split(",")]
    items = t.lineitem.withColumn("v", F.expr(_styled)).groupBy("l_orderkey").agg(ordered_array(col("v"), order).alias("items"))
    return items.select("l_orderkey", array_text(col("items")).alias("rendered"))


@check("group_dedupe", "SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders GROUP BY 1, 2, 3")
def _(t):
    columns = ["o_custkey", "o_orderpriority", "o_orderstatus"]
    return t.orders.select(*columns).dropDuplicates(columns)


@check(
    "wide_key_group",
    """SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, count(DISTINCT o_orderpriority) AS priorities, count(*) AS n
       FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4, 5""",
)
def _(t):
    """The key functionally depends on the customer, so orders are grouped on that alone."""
    counts = t.orders.groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("priorities"), F.count("*").alias("n"))
    return t.customer.join(counts.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal", "priorities", "n"
    )


@check(
    "two_level_aggregate",
    """SELECT o_custkey, max(n) AS busiest, min(day) AS first_day FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    days = t.orders.groupBy("o_custkey", order_day().alias("day")).agg(F.count("*").alias("n"))
    return days.groupBy("o_custkey").agg(F.max("n").alias("busiest"), F.min("day").alias("first_day"))


@check(
    "age_today",
    "SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), current_date) AS INTEGER) AS days, CAST(o_orderdate AS DATE) <= current_date AS past FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", days_between(order_day(), F.current_date()).cast("int").alias("days"), (order_day() <= F.current_date()).alias("past"))


# ------------------------------------------------------------------ windows, sort, top-k


def _row_number(order: str, keys: str = "o_custkey") -> str:
    return f"CAST(row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS INTEGER)"


@check("latest_first_rank", f"SELECT o_custkey, o_orderkey, {_row_number('o_orderdate DESC NULLS FIRST, o_orderkey')} AS rank FROM orders")
def _(t):
    ranks = rank_all(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], newest_first=True)
    return ranks.select("o_custkey", "o_orderkey", "rank")


@check("earliest_first_rank", f"SELECT o_custkey, o_orderkey, {_row_number('o_orderdate NULLS LAST, o_orderkey')} AS rank FROM orders")
def _(t):
    return rank_all(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select("o_custkey", "o_orderkey", "rank")


_party = "CASE WHEN o_orderpriority < '4' THEN NULL ELSE o_custkey END"


@check("rank_hot_keys", f"SELECT o_orderkey, {_row_number('o_orderdate DESC NULLS FIRST, o_orderkey', _party)} AS rank FROM orders")
def _(t):
    """The null key has more than half of the rows."""
    rows = t.orders.withColumn("party", F.when(col("o_orderpriority") >= "4", col("o_custkey")))
    return rank_all(rows, ["party"], "o_orderdate", ["o_orderkey"], newest_first=True).select("o_orderkey", "rank")


@check(
    "last_line_per_key",
    "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey, l_suppkey) = 1",
)
def _(t):
    last = first_per(t.lineitem, ["l_orderkey"], [down("l_linenumber"), up("l_partkey"), up("l_suppkey")])
    return last.select("l_orderkey", "l_partkey", "l_linenumber")


@check(
    "multi_key_ranking",
    f"""SELECT l_orderkey, l_partkey, {_row_number('l_shipdate, l_linenumber DESC, l_partkey, l_suppkey', 'l_orderkey')} AS position FROM lineitem""",
)
def _(t):
    ties = [down("l_linenumber"), up("l_partkey"), up("l_suppkey")]
    return ranked(t.lineitem, ["l_orderkey"], "l_shipdate", ties, name="position").select("l_orderkey", "l_partkey", "position")


_grade = "CASE WHEN o_orderpriority < '3' THEN 'high' ELSE 'low' END"


@check(
    "derived_partition_rank",
    f"SELECT o_custkey, {_grade} AS grade, o_orderkey, {_row_number('o_orderdate, o_orderkey', f'o_custkey, {_grade}')} AS rank FROM orders",
)
def _(t):
    graded = t.orders.withColumn("grade", F.when(col("o_orderpriority") < "3", "high").otherwise("low"))
    return rank_all(graded, ["o_custkey", "grade"], "o_orderdate", ["o_orderkey"]).select("o_custkey", "grade", "o_orderkey", "rank")


@check(
    "window_before_distinct",
    f"SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day, {_row_number('o_orderdate, o_orderkey')} AS rank FROM orders",
)
def _(t):
    """Ranks are unique within a key, so the duplicate removal has nothing to do and is left out."""
    return rank_all(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select("o_custkey", order_day().alias("day"), "rank")


@check("final_sort", "SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey")
def _(t):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate").orderBy(up("o_orderpriority"), down("o_orderdate"), up("o_orderkey"))


@check(
    "first_per_key",
    "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey",
)
def _(t):
    return first_per(t.orders, ["o_custkey"], [up("o_orderdate"), up("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderdate")


@check(
    "last_per_key",
    "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1",
)
def _(t):
    return first_per(t.orders, ["o_custkey"], [down("o_orderdate"), up("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@check(
    "top3_pivot",
    """SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_orderkey END) AS order_1, max(CASE WHEN rn = 2 THEN o_orderkey END) AS order_2,
       max(CASE WHEN rn = 3 THEN o_orderkey END) AS order_3
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 3 GROUP BY 1""",
)
def _(t):
    top = first_per(t.orders, ["o_custkey"], [up("o_orderdate"), up("o_orderkey")], n=3, rank="rn")
    return spread_top(top, ["o_custkey"], "rn", {"o_orderkey": "order_{n}"}, 3)


@check(
    "boolean_sort_key",
    f"""SELECT o_custkey, o_orderkey FROM (SELECT *, {_row_number('o_orderdate, o_orderkey')} AS rank FROM orders)
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY rank) = 1""",
)
def _(t):
    """A pick sorted by "rank is 1" would return any other row; the intended one is the lowest rank."""
    return first_per(t.orders, ["o_custkey"], [up("o_orderdate"), up("o_orderkey")]).select("o_custkey", "o_orderkey")


# ------------------------------------------------------------------ set operations


@check(
    "union_dedupe",
    "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def _(t):
    done = t.orders.where("o_orderstatus = 'F'").select(col("o_custkey").alias("k"))
    return done.union(t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")).distinct()


@check(
    "union_by_name",
    "SELECT 'customer' AS kind, c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier",
)
def _(t):
    customers = t.customer.select(lit("customer").alias("kind"), col("c_custkey").alias("id"), col("c_nationkey").alias("nation"))
    suppliers = t.supplier.select(col("s_nationkey").alias("nation"), col("s_suppkey").alias("id"), lit("supplier").alias("kind"))
    return customers.unionByName(suppliers)


@check(
    "positional_union",
    "SELECT o_custkey AS pat_id, CAST(o_orderdate AS DATE) AS start_date FROM orders UNION ALL SELECT l_suppkey, CAST(l_shipdate AS DATE) FROM lineitem",
)
def _(t):
    other = t.lineitem.select("l_suppkey", col("l_shipdate").cast("date"))
    return t.orders.select(col("o_custkey").alias("pat_id"), order_day().alias("start_date")).union(other)


# ------------------------------------------------------------------ scalar functions


@check(
    "text_functions",
    """SELECT p_partkey, coalesce(nullif(CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END, ''), 'unnamed') AS shown, CAST(p_partkey AS VARCHAR) AS id_text,
       lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, replace(p_brand || '.1', '.', '') AS stripped, split_part(p_name, ' ', 1) AS first_word,
       concat(p_type, '/', p_brand) AS joined FROM part""",
)
def _(t):
    name = F.when(col("p_size") % 5 == 0, "").otherwise(col("p_name"))
    return t.part.select(
        "p_partkey",
        F.coalesce(blank_to_null(name), lit("unnamed")).alias("shown"),
        text("p_partkey").alias("id_text"),
        F.lpad(text("p_size"), 4, "0").alias("padded"),
        strip_dots(F.concat("p_brand", lit(".1"))).alias("stripped"),
        F.split_part("p_name", lit(" "), lit(1)).alias("first_word"),
        F.concat("p_type", lit("/"), "p_brand").alias("joined"),
    )


_raw = """CASE l_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN ' 12.5 ' ELSE CAST(CAST(l_quantity AS INT) AS STRING) || '.75' END"""


@check(
    "safe_numbers",
    f"""SELECT l_returnflag, CAST(sum(v) AS DECIMAL(38,9)) AS total, count(v) AS readable, count(*) FILTER (WHERE v IS NULL AND raw <> '') AS rejected FROM (
        SELECT l_returnflag, {_raw} AS raw, TRY_CAST(nullif(trim({_raw}), '') AS DECIMAL(38,9)) AS v FROM lineitem) GROUP BY 1""",
)
def _(t):
    raw = F.expr(_raw)
    values = t.lineitem.select("l_returnflag", to_number(raw).alias("v"), is_rejected(raw).alias("bad"))
    return values.groupBy("l_returnflag").agg(
        F.sum("v").cast("decimal(38,9)").alias("total"), F.count("v").alias("readable"), F.count_if("bad").alias("rejected")
    )


@check(
    "number_functions",
    """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) / 1000, 0) AS INTEGER) AS rounded, CAST(floor(o_totalprice / 1000) AS BIGINT) AS floored,
       CAST(round(date_diff('day', DATE '1960-02-29', CAST(o_orderdate AS DATE)) / 365.25, 6) AS DECIMAL(18,6)) AS age FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        to_whole(col("o_totalprice").cast("decimal(18,2)") / 1000).alias("rounded"),
        F.floor(col("o_totalprice") / 1000).alias("floored"),
        age_in_years(days_between(lit("1960-02-29"), order_day())).alias("age"),
    )


@check(
    "calendar_functions",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 YEAR AS DATE) AS two_years_before, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS DATE) AS year_after,
       CAST(o_orderdate AS DATE) - 7 AS week_before, o_orderdate - INTERVAL 48 HOUR AS two_days_before, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
       strftime(o_orderdate, '%Y-%m-%d') AS day_text, CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days_to_as_of FROM orders""",
)
def _(t):
    as_of = lit("2002-01-01").cast("date")
    return t.orders.select(
        "o_orderkey",
        shift(order_day(), "2 YEARS", -1).cast("date").alias("two_years_before"),
        shift(order_day(), "1 YEAR").cast("date").alias("year_after"),
        F.date_sub(order_day(), 7).alias("week_before"),
        shift(col("o_orderdate"), "48 HOURS", -1).alias("two_days_before"),
        F.extract(lit("YEAR"), order_day()).cast("int").alias("year"),
        F.date_format(order_day(), "yyyy-MM-dd").alias("day_text"),
        F.try_to_date(F.date_format(order_day(), "yyyyMMdd"), "yyyyMMdd").alias("parsed"),
        days_between(order_day(), as_of).cast("long").alias("days_to_as_of"),
    )


@check(
    "day_counts",
    """SELECT event_id, DATE '1840-12-31' + CAST(round(CAST(value AS DECIMAL(18,4)), 0) AS INTEGER) AS from_count,
       CASE WHEN value >= 0.5 THEN DATE '1840-12-31' + CAST(round(CAST(value AS DECIMAL(18,4)), 0) AS INTEGER) END AS without_sentinel,
       CAST(date_diff('day', DATE '2024-01-10', CAST(ts AS DATE)) AS INTEGER) AS calendar_days,
       CAST(trunc(epoch(ts - TIMESTAMP '2024-01-10 12:00:00') / 86400) AS INTEGER) AS whole_days FROM events""",
)
def _(t):
    counted = date_from_day_count(col("value").cast("decimal(18,4)"))
    return t.events.select(
        "event_id",
        counted.alias("from_count"),
        null_if_sentinel(counted).alias("without_sentinel"),
        days_between(lit("2024-01-10"), col("ts")).alias("calendar_days"),
        whole_days(lit("2024-01-10 12:00:00"), col("ts")).alias("whole_days"),
    )


# ------------------------------------------------------------------ composite operators


@check(
    "key_unpivot",
    """SELECT DISTINCT l_returnflag, key, role FROM (SELECT l_returnflag, CAST(l_orderkey AS VARCHAR) AS key, 'order' AS role FROM lineitem
       UNION ALL SELECT l_returnflag, CAST(l_partkey AS VARCHAR), 'part' FROM lineitem UNION ALL
       SELECT l_returnflag, CASE WHEN l_suppkey % 3 <> 0 THEN CAST(l_suppkey AS VARCHAR) END, 'supplier' FROM lineitem) WHERE key IS NOT NULL""",
)
def _(t):
    labels = {
        "order": text("l_orderkey"),
        "part": text("l_partkey"),
        "supplier": F.when(col("l_suppkey") % 3 != 0, text("l_suppkey")),
    }
    return unpivot_keys(t.lineitem, labels, "key", "role", keep=["l_returnflag"])


@check(
    "prefer_source",
    """SELECT c_custkey, CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_orderkey ELSE p.o_orderkey END AS order_key,
       CASE WHEN f.o_orderkey IS NOT NULL THEN f.o_orderpriority ELSE p.o_orderpriority END AS priority FROM customer
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1) f ON f.o_custkey = c_custkey
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1) p ON p.o_custkey = c_custkey""",
)
def _(t):
    people = t.customer.select("c_custkey")
    for status in ("F", "P"):
        side = first_per(t.orders.where(col("o_orderstatus") == status), ["o_custkey"], [up("o_orderdate"), up("o_orderkey")])
        people = lookup(people, side, {"c_custkey": "o_custkey"}, {"o_orderkey": f"key_{status}", "o_orderpriority": f"priority_{status}"})
    chosen = prefer(
        col("key_F").isNotNull(),
        {"order_key": col("key_F"), "priority": col("priority_F")},
        {"order_key": col("key_P"), "priority": col("priority_P")},
        "chosen",
    )
    return people.select("c_custkey", chosen).select("c_custkey", "chosen.*")


_shapes = f"SELECT l_orderkey, l_linenumber, l_partkey, {DATE_TEXT} AS raw FROM (SELECT *, l_orderkey + l_linenumber AS shape, CAST(l_shipdate AS DATE) AS d FROM lineitem) t"
_y, _m, _d = ("split_part(raw, sep, {})".format(i) for i in (3, 1, 2))


def _date(year: str, month: str, day: str) -> str:
    return f"TRY_CAST({year} || '-' || lpad({month}, 2, '0') || '-' || lpad({day}, 2, '0') AS DATE)"


@check(
    "multi_format_dates",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, raw, CASE shape % 9
          WHEN 0 THEN {_date('right(raw, 4)', 'substr(lpad(raw, 8, $$0$$), 1, 2)', 'substr(lpad(raw, 8, $$0$$), 3, 2)')}
          WHEN 1 THEN {_date(_m, _d, _y)}
          WHEN 6 THEN {_date(_y, _d, _m)} WHEN 4 THEN {_date(_y, _d, _m)}
          WHEN 5 THEN {_date(_y, _m, _d)}
          WHEN 2 THEN {_date(f"(CASE WHEN {_y} >= '70' THEN '19' ELSE '20' END || {_y})", _m, _d)}
          WHEN 3 THEN {_date(f"(CASE WHEN {_y} >= '70' THEN '19' ELSE '20' END || {_y})", _m, _d)} END AS parsed
        FROM (SELECT *, l_orderkey + l_linenumber AS shape, CASE WHEN raw LIKE '%/%' THEN '/' ELSE '-' END AS sep FROM ({_shapes}))""",
)
def _(t):
    rows = role_frame(t, _shapes)
    return rows.withColumn("parsed", parse_dates(col("raw")))


def _part_code(k: str) -> str:
    return f"'C' || CAST({k} % 500 AS STRING) || '.' || CAST({k} % 7 AS STRING)"


@check(
    "code_normalize",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(a.code, b.code) AS code FROM (SELECT *, replace({_part_code('l_partkey')}, '.', '') AS raw FROM lineitem)
        LEFT JOIN (SELECT DISTINCT {_part_code('p_partkey')} AS code FROM part WHERE p_size <= 20) a ON replace(a.code, '.', '') = raw
        LEFT JOIN (SELECT DISTINCT {_part_code('p_partkey')} AS code FROM part WHERE p_type <> 'PROMO') b ON replace(b.code, '.', '') = raw""",
)
def _(t):
    code = F.expr(_part_code("p_partkey"))
    lines = t.lineitem.withColumn("raw", strip_dots(F.expr(_part_code("l_partkey"))))
    first, second = (t.part.where(kept).select(code.alias("code")) for kept in ("p_size <= 20", "p_type <> 'PROMO'"))
    return normalize_codes(lines, {"raw": "code"}, first, second).select("l_orderkey", "l_linenumber", "l_partkey", "code")


@check(
    "lookup_chain",
    """SELECT l_orderkey, l_linenumber, l_partkey, coalesce(a.p_name, b.p_brand, c.p_type) AS label FROM lineitem
       LEFT JOIN part a ON a.p_partkey = l_partkey AND a.p_type = 'PROMO' LEFT JOIN part b ON b.p_partkey = l_partkey AND b.p_size <= 20 AND a.p_partkey IS NULL
       LEFT JOIN part c ON c.p_partkey = l_partkey AND c.p_brand < 'Brand#2' AND a.p_partkey IS NULL AND b.p_partkey IS NULL""",
)
def _(t):
    dims = [
        t.part.where("p_type = 'PROMO'").select("p_partkey", "p_name"),
        t.part.where("p_size <= 20").select("p_partkey", "p_brand"),
        t.part.where("p_brand < 'Brand#2'").select("p_partkey", "p_type"),
    ]
    return lookup_chain(t.lineitem, {"l_partkey": "label"}, dims).select("l_orderkey", "l_linenumber", "l_partkey", "label")


@check(
    "practice_location",
    """SELECT c_custkey, coalesce(i.n_name, x.s_name) AS pcp_location,
       CASE WHEN i.n_name IS NOT NULL THEN 'Internal' WHEN nullif(x.s_name, '') IS NOT NULL THEN 'External' ELSE 'Unknown' END AS pcp_location_type
       FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 2) i ON i.n_nationkey = c_nationkey
       LEFT JOIN (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END AS s_name FROM supplier WHERE s_acctbal < 6000) x ON x.s_suppkey = c_nationkey""",
)
def _(t):
    inside = t.nation.where("n_regionkey < 2").select("n_nationkey", "n_name")
    outside = t.supplier.where("s_acctbal < 6000").select("s_suppkey", F.when(col("s_suppkey") % 4 == 0, "").otherwise(col("s_name")).alias("s_name"))
    placed = practice_location(t.customer, "c_nationkey", inside, outside, blank_is_missing=False)
    return placed.select("c_custkey", "pcp_location", "pcp_location_type")


@check(
    "limited_dataset",
    """SELECT DISTINCT 'N' || CAST(c_custkey * 3 AS VARCHAR) AS number, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def _(t):
    crosswalk = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", F.concat(lit("N"), (col("c_custkey") * 3).cast("string")).alias("number"))
    return limited_dataset(t.customer, crosswalk, "c_custkey", "number", ["c_nationkey", "c_mktsegment"])


@check(
    "deidentified_dataset",
    """WITH w AS (SELECT id, row_number() OVER (ORDER BY sha256(id)) AS token FROM (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders) t)
       SELECT DISTINCT 'N' || CAST(o_custkey * 3 AS VARCHAR) AS number, token, o_orderdate + (o_custkey % 100) * INTERVAL 1 DAY AS o_orderdate, o_orderstatus
       FROM orders JOIN w ON id = CAST(o_orderkey AS VARCHAR)""",
)
def _(t):
    number = F.concat(lit("N"), (col("c_custkey") * 3).cast("string")).alias("number")
    crosswalk = t.customer.select(col("c_custkey").alias("o_custkey"), number, (col("c_custkey") % 100).alias("days"))
    walk = extend_crosswalk(None, distinct_ids(t.orders, {"o_orderkey": "o_orderkey"}), order=lambda id: F.sha2(id, 256))
    return deidentify(
        t.orders, crosswalk, "o_custkey", "number", "days", ["o_orderdate", "o_orderstatus"], ["o_orderdate"], {"o_orderkey": "token"}, walk
    )


@check(
    "surrogates_kept",
    """WITH a AS (SELECT id, row_number() OVER (ORDER BY sha256(id)) AS number FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F') t),
       b AS (SELECT id, row_number() OVER (ORDER BY sha256(id)) + (SELECT max(number) FROM a) AS number
         FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders) t WHERE id NOT IN (SELECT id FROM a))
       SELECT 'customer' AS kind, id, number FROM a UNION ALL SELECT 'customer', id, number FROM b""",
)
def _(t):
    def hashed(id):
        return F.sha2(id, 256)

    sink, kinds = shared_workspace(t.spark), {"o_custkey": "customer"}
    first = sink.publish("surrogates", extend_crosswalk(None, distinct_ids(t.orders.where("o_orderstatus = 'F'"), kinds), hashed))
    return sink.publish("surrogates", extend_crosswalk(first, distinct_ids(t.orders, kinds), hashed))


@check(
    "categorized_orders",
    """SELECT o_custkey, min(o_orderdate) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS first_fast,
       min(o_orderdate) FILTER (WHERE o_orderpriority = '5-LOW') AS first_slow FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY 1""",
)
def _(t):
    sorted_orders = categorize(t.orders, "o_orderpriority", {"fast": ["1-URGENT", "2-HIGH"], "slow": ["5-LOW"]}, "category")
    return pivot_first(sorted_orders, ["o_custkey"], "category", "o_orderdate", {"fast": "first_fast", "slow": "first_slow"})


@check(
    "notes_matching",
    r"""SELECT doc_id FROM documents WHERE regexp_matches(text, '(the.*and|ing\b)', 'is') AND NOT (text LIKE '%Eau%') AND NOT (text LIKE '%license%')
        AND (lower(text) LIKE '%the%and%' OR lower(text) LIKE '%ing %')""",
)
def _(t):
    return matching(t.documents, "text", include=["%THE%AND%", "%ing %"], exclude=["%Eau%", "%license%"]).select("doc_id")


@check(
    "kv_pivot",
    """SELECT user_id, max(props) FILTER (WHERE event_type = 'view') AS last_view, max(props) FILTER (WHERE event_type IN ('click', 'purchase')) AS action,
       max(TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER)) FILTER (WHERE event_type = 'error') AS worst_error FROM events GROUP BY 1""",
)
def _(t):
    return elements_pivot(
        t.events,
        ["user_id"],
        "event_type",
        "props",
        {"last_view": "view", "action": ["click", "purchase"], "worst_error": "error"},
        cast={"worst_error": lambda c: F.regexp_extract(c, "[0-9]+", 0).try_cast("int")},
    )


@check(
    "days_from_anchor",
    """SELECT o_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_to_ship,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS days_to_close FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def _(t):
    joined = t.orders.join(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
    metrics = days_from(order_day(), {"days_to_ship": col("l_shipdate"), "days_to_close": lit("2002-01-01")})
    return joined.select("o_orderkey", "l_linenumber", "l_partkey", *metrics)


@check(
    "age_at_event",
    """SELECT o_orderkey, CAST(round(date_diff('day', DATE '1950-01-01' + CAST(o_custkey % 9000 AS INTEGER), CAST(o_orderdate AS DATE)) / 365.25, 6) AS DECIMAL(18,6)) AS age,
       CAST(floor(date_diff('day', DATE '1950-01-01' + CAST(o_custkey % 9000 AS INTEGER), CAST(o_orderdate AS DATE)) / 365.25) AS BIGINT) AS years FROM orders""",
)
def _(t):
    born = F.date_add(lit("1950-01-01").cast("date"), (col("o_custkey") % 9000).cast("int"))
    age = age_in_years(whole_days(born, order_day()))
    return t.orders.select("o_orderkey", age.alias("age"), F.floor(age).cast("long").alias("years"))


@check(
    "prefix_labels",
    """SELECT o_orderkey, CASE WHEN starts_with(o_orderpriority, '1') THEN 'I' WHEN starts_with(o_orderpriority, '2') THEN 'II' ELSE o_orderpriority END AS grade FROM orders""",
)
def _(t):
    return t.orders.select("o_orderkey", by_prefix(col("o_orderpriority"), [("1", "I"), ("2", "II")]).alias("grade"))


@check(
    "harmonized_model",
    """SELECT 'A' AS site, 'A' || CAST(c_custkey AS VARCHAR) AS patient_key, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(12,2)) AS balance, CAST(NULL AS VARCHAR) AS nation
       FROM customer WHERE c_mktsegment < 'G'
       UNION ALL SELECT 'B', 'B' || CAST(c_custkey AS VARCHAR), NULL, CAST(c_acctbal AS DECIMAL(12,2)), n_name FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment > 'G'""",
)
def _(t):
    model = {"patient_key": "string", "segment": "string", "balance": "decimal(12,2)", "nation": "string"}
    even = t.customer.where("c_mktsegment < 'G'")
    odd = t.customer.where("c_mktsegment > 'G'").join(t.nation, col("n_nationkey") == col("c_nationkey"))
    return harmonize(
        {
            "A": (even, {"patient_key": F.concat(lit("A"), "c_custkey"), "segment": col("c_mktsegment"), "balance": col("c_acctbal")}),
            "B": (odd, {"patient_key": F.concat(lit("B"), "c_custkey"), "balance": col("c_acctbal"), "nation": col("n_name")}),
        },
        model,
    )
