"""Exact duplicates of whole texts, safe against very large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import cut, sent_if_small, stored

SALTS = 32
MOST_DIGESTS = 300_000  # repeated digests sent to all executors at most; beyond, a join shuffles


def normal_text(text: str) -> Column:
    """Null as empty; each run of ``[\\x20\\x09-\\x0D]`` as one space (single spaces are not rewritten)."""
    runs = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), runs, " ")


def sha256(column: Column) -> Column:
    return F.unhex(F.sha2(column.cast("binary"), 256))


def exact_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct text of rows (id, norm, digest): digest, norm, keep_id, group_size.

    Three combining steps group by digest and full text: inside each task, over (digest, salt), so
    that the tasks which hold a very large group spread over ``salts`` reducers, and over the
    digest, where a group has at most ``salts`` rows left.
    """
    rows = rows.withColumn("salt", F.spark_partition_id() % salts)
    salted = rows.groupBy("digest", "salt", "norm").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return salted.groupBy("digest", "norm").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest (binary) of the normalised text.

    The smallest id of a group stays. A first pass keeps ids and digests only: a digest that occurs
    once is a text that occurs once. The texts of all other digests are compared whole, in the
    steps of :func:`exact_groups`. Members find their group by the digest, which is enough as each
    digest turned out to have one text; if any has several, they are joined on the text as well.

    Null texts count as empty texts, so all of them form one group with the empty ones. Null ids
    stay only in a group without any other id. Rows that repeat the smallest id are all kept, as
    an id names one document. An empty table gives no rows; further columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), normal_text(text).alias("norm")).withColumn("digest", digest(F.col("norm")))
    names = stored(rows.select("id", "digest"))
    repeated = names.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    some = rows.join(sent_if_small(repeated, MOST_DIGESTS), "digest", "left_semi")
    groups = exact_groups(some, salts)
    slim = cut(groups.drop("norm"))
    collided = slim.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    if collided.isEmpty():
        joined = names.join(slim, "digest", "left")
    else:
        joined = rows.join(groups, ["digest", "norm"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    joined = joined.withColumn("keep_id", keep).withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
    return joined.select(F.col("id").alias(id), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
