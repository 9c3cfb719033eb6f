"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm.common import documents, stored

SHARD_BYTES = 32 << 20
BITS = 48
#: Bits looked at in one pass over the keys.
STEP = 8


def document_hash(doc_id: Column, text: Column) -> Column:
    """The first 48 bits of the MD5 of id and text."""
    body = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(body), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column | int) -> Column:
    """The first ``depth`` of the 48 bits."""
    return F.floor(h / F.pow(F.lit(2.0), F.lit(BITS) - depth)).cast("long")


def grow_directory(keys: DataFrame, limit: int) -> DataFrame:
    """The buckets (depth, prefix, shard_bytes, shard_rows) in which keys (h, bytes, n) end.

    All keys begin in one bucket. Only a bucket over the limit is split on its
    next bit, until it fits or its bits are used up. A pass over the keys of
    the buckets still open counts eight bits ahead, so the number of passes
    follows the depth; tables passed on have a row per bucket.
    """
    spark = keys.sparkSession
    total = keys.agg(F.sum("bytes").alias("b"), F.sum("n").alias("n")).first()
    done = spark.createDataFrame([], "depth int, prefix long, shard_bytes long, shard_rows long")
    if total.n is None:
        return done
    if total.b <= limit:
        return spark.createDataFrame([(0, 0, total.b, total.n)], done.schema)
    inside, depth = keys, 0
    while True:
        ahead = min(STEP, BITS - depth)
        counted = inside.groupBy(_prefix(F.col("h"), depth + ahead).alias("p")).agg(F.sum("bytes").alias("b"), F.sum("n").alias("n"))
        sizes = stored(
            counted.select("b", "n", F.explode(F.sequence(F.lit(depth + 1), F.lit(depth + ahead))).alias("depth"), "p")
            .groupBy("depth", F.expr(f"shiftrightunsigned(p, {depth + ahead} - depth)").alias("prefix"))
            .agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows")), "shard-sizes")
        parents = sizes.where(F.col("shard_bytes") > limit).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_parent"))
        split = sizes.withColumn("_parent", F.expr("shiftrightunsigned(prefix, 1)"))
        reached = split.where(F.col("depth") == depth + 1).unionByName(
            split.where(F.col("depth") > depth + 1).join(parents, ["depth", "_parent"], "left_semi").select(split.columns))
        last = depth + ahead == BITS
        ends = F.col("shard_bytes") <= limit
        done = done.unionByName(reached.where(ends | (F.lit(last) & (F.col("depth") == BITS))).select(done.columns))
        depth += ahead
        still_open = reached.where(~ends & (F.col("depth") == depth)).select(F.col("prefix").alias("_open"))
        if last or still_open.isEmpty():
            return stored(done, "shard-directory")
        inside = keys.join(still_open, _prefix(F.col("h"), depth) == F.col("_open"), "left_semi")


def look_up(rows: DataFrame, directory: DataFrame, h: str) -> DataFrame:
    """``rows`` with the bucket of each: equal in the bits all buckets have, then in the bucket's own."""
    least = directory.agg(F.min("depth")).first()[0] or 0
    buckets = directory.withColumn("_short", F.expr(f"shiftrightunsigned(prefix, depth - {least})"))
    met = (_prefix(F.col(h), least) == F.col("_short")) & (_prefix(F.col(h), F.col("depth")) == F.col("prefix"))
    return rows.join(buckets, met).drop("_short")


def _bits() -> Column:
    return F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(conv(prefix, 10, 2), depth, '0')"))


def extendible_shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with shard (its bits as text), shard_bytes and shard_rows.

    The size of a document is the length of its text in UTF-8; a missing text
    has none. Every shard fits the limit unless it is one document that alone
    is larger. Rows equal in id and text share all bits; if such a group does
    not fit, its rows are numbered in a stored table and split by the hash of
    that number, after a dot. No rows give no rows; other columns are kept.
    """
    taken = {"shard", "shard_bytes", "shard_rows"} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"rename the columns {sorted(taken)} first")
    h = document_hash(F.col("doc_id"), F.col("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    keys = stored(docs.select(h.alias("h"), size.alias("bytes")).groupBy("h").agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-keys")
    directory = grow_directory(keys, limit)
    names = docs.columns
    doc = F.struct(*names).alias("doc")
    found = look_up(docs.select(doc, h.alias("h")), directory, "h").withColumn("shard", _bits())
    columns = ["doc.*", "shard", "shard_bytes", "shard_rows"]
    crowded = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    if directory.where(crowded).isEmpty():
        return found.select(*columns)
    numbered = stored(found.where(crowded).select("doc", "shard", F.monotonically_increasing_id().alias("nth")), "shard-crowded")
    second = numbered.withColumn("h", F.expr(f"shiftrightunsigned(xxhash64(nth), {64 - BITS})"))
    parts = []
    for group in [r.shard for r in directory.where(crowded).withColumn("shard", _bits()).select("shard").toLocalIterator()]:
        own = second.where(F.col("shard") == group)
        grown = grow_directory(own.select("h", F.coalesce(F.octet_length("doc.text"), F.lit(0)).cast("long").alias("bytes"), F.lit(1).alias("n")), limit)
        parts.append(look_up(own, grown, "h").withColumn("shard", F.concat_ws(".", "shard", _bits())))
    result = found.where(~crowded).select(*columns)
    for part in parts:
        result = result.unionByName(part.select(*columns))
    return result


def op8_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return extendible_shards(docs).select("doc_id", "shard", "shard_bytes", "shard_rows")


SQL = f"""
WITH keyed AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, {BITS // 4}) AS BIGINT) AS h
  FROM documents
), deep AS (
  SELECT doc_id, bytes, depth, h >> ({BITS} - depth) AS prefix FROM keyed, (SELECT unnest(range(0, {BITS + 1})) AS depth) AS d
), sized AS (
  SELECT doc_id, depth, prefix, sum(bytes) OVER (PARTITION BY depth, prefix) AS shard_bytes,
         count(*) OVER (PARTITION BY depth, prefix) AS shard_rows
  FROM deep
), chosen AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS nth FROM sized
  WHERE shard_bytes <= {SHARD_BYTES} OR depth = {BITS}
)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE substr(lpad(bin(prefix), {BITS}, '0'), {BITS} - CAST(depth AS INTEGER) + 1) END AS shard,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows
FROM chosen WHERE nth = 1
"""
