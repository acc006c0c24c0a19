"""A corpus pipeline of the training-data operators: each stage works on what the one before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chartloom.llm import exact, jaccard, langid, packing, pii
from chartloom.llm.shared import sent_if_small, shared_folder
from chartloom.llm.ship import ship

ORACLE_SQL = None  # language identification, near duplicates and token ids are not SQL
LEAST_SCORE = 0.3


def bounded(spark: SparkSession) -> SparkSession:
    """Code on the workers, and batches of rows small enough that their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return ship(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: texts without letters, or with no clear language, go.

    The columns of the documents are kept as they are. Null and empty texts go; rows are judged one
    by one, so repeated rows and ids, null ids and further columns change nothing. An empty table
    gives no rows.
    """
    bounded(spark)
    learn = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    model = langid.fit(learn, public_tokenizers.path("piece_bpe_32k.model"))
    judged = langid.with_language(docs, model, "text", [F.col(c) for c in docs.columns], kept_text="text")
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (white space aside), the one with the smallest id stays.

    Rows are decided by id and text together, so a text is not lost because its id stands on a copy
    too. Rows that repeat id and text count as copies: one of them stays. Null texts equal empty
    ones; a null id stays only without any other. An empty table gives no rows.
    """
    bounded(spark)
    found = exact.exact_duplicates(docs)
    found = found.groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("found")).agg(F.first("kept").alias("kept"), F.count("*").alias("n"))
    marked = sent_if_small(found.where("NOT kept OR n > 1"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("own_id"), exact.sha256(exact.normal_text("text")).alias("digest"))
    rows = rows.join(marked, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("found")), "left")
    once = rows.where("n IS NULL").select("doc.*")
    if marked.where("kept").isEmpty():
        return once
    return once.unionByName(rows.where("kept").dropDuplicates(["own_id", "digest"]).select("doc.*"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingles of five words, similarity 0.8), the document with the smallest id stays.

    Documents whose id is null or stands on several rows stay all, since the groups name documents
    by their ids. Null and empty texts are in no group. An empty table gives no rows.
    """
    bounded(spark)
    groups = jaccard.near_duplicate_groups(docs)
    copies = groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.first("component_id").alias("component_id"))
    dropped = copies.where("n = 1 AND doc_id <> component_id").select("doc_id")
    return docs.join(sent_if_small(dropped), "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; n_chars follows the text.

    The fixed patterns are matched as the text is rewritten; only documents with identifiers found
    by learned contexts need a join, which is on id and text. Null texts stay null; repeated rows
    and null ids are rewritten like others. An empty table gives no rows.
    """
    bounded(spark)
    key = F.struct(F.length("text"), F.xxhash64("text"))
    found = pii.personal_data(docs.select("doc_id", "text", key.alias("key")), keep=("key",)).where("size(spans) > size(base)")
    found = found.select(F.col("doc_id").alias("id"), F.col("key").alias("found"), "spans").dropDuplicates(["id", "found"])
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("own_id"), key.alias("key"))
    rows = rows.join(sent_if_small(found), F.col("own_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("found")), "left")
    slim = F.transform(pii.base_spans(F.coalesce("doc.text", F.lit(""))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = rows.select("doc", pii.redacted(F.col("doc.text"), F.coalesce("spans", slim)).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"doc.`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 4096 tokens: one row per piece of a document.

    Null and empty texts are a piece of the end id alone; repeated rows are packed each. An empty
    table gives no rows.
    """
    bounded(spark)
    return packing.best_fit_packing(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("personal_data", personal_data),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
