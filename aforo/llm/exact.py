"""Exact duplicates: 128-bit content hash, bytes compared inside the hash groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm.common import documents, lower_ascii


def content_hash(body: Column) -> Column:
    return F.unhex(F.md5(body))


def exact_dedup(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document with its group of equal texts.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Texts are equal
    when identical after lower-casing A-Z; a missing text is an empty one. The
    largest doc_id of a group stays.

    The full texts cross the network once, as keys of a hash aggregation that
    folds copies before the shuffle, so a huge group is one row per map task.
    Grouping by hash *and* text compares the bytes inside every hash group:
    texts that merely share a hash end as different groups, told apart by
    their SHA-256 when the documents look up their group.

    Repeated rows: of rows with the same id and text exactly one is kept. A
    missing doc_id loses against any other; a group with missing ids only has
    no keep_id and keeps one of them. No rows give no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("body"))
    digest = F.sha2("body", 256).alias("text_sha256")
    groups = (
        rows.withColumn("h", hash_of(F.col("body")))
        .groupBy("h", "body").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", digest, "keep_id", "group_size")
    )
    # Rows with the same id and text, counted and dealt out again, so that one of them can be the one that stays.
    members = (
        rows.select("doc_id", hash_of(F.col("body")).alias("h"), digest)
        .groupBy("h", "text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    )
    return (
        members.join(groups, ["h", "text_sha256"])
        .select("doc_id", "keep_id", "group_size", "text_sha256",
                F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("nth"))
        .select("doc_id", "keep_id", "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256")
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = """
WITH bodies AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
), grouped AS (
  SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
  FROM bodies
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM grouped
"""
