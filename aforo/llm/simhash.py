"""Near duplicates by SimHash, found with covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.llm.common import documents, in_bytes, stored
from aforo.llm.graph import components

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 1 << 18


def fingerprint(text: str | None) -> int:
    """64 bits, each set when set in over half of the shingles' hashes; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
        total = len(words) - SHINGLE + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for begin in range(0, total, BLOCK):
        size = min(BLOCK, total - begin)
        hashes = np.fromiter((digest(s, SEED) for _, s in zip(range(size), shingles)), np.uint64, size)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_bytes(batches, "text"):
        found = [fingerprint(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {kind}, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """Bit masks such that any ``radius`` bit positions are left out together by one of them.

    Position i gets a vector of radius + 1 bits, other than zero, in turn. The
    mask of a vector v keeps the positions whose vector has an odd product
    with v. ``radius`` vectors in radius + 1 dimensions have a v orthogonal to
    all of them, so two fingerprints that differ in these positions agree
    under v's mask.
    """
    size = 1 << (radius + 1)
    own = [i % (size - 1) + 1 for i in range(64)]
    return [sum(1 << i for i in range(64) if (own[i] & v).bit_count() % 2) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` within two bits, enough to connect all such pairs.

    A fingerprint enters one bucket per mask; buckets with a single one are
    dropped. Within a bucket nothing is compared pairwise: fingerprints there
    differ only in bits the mask leaves out, so each posts itself and its
    changes of one such bit, and two fingerprints meet at a posting exactly if
    they are within two bits. At most 65 meet at one, however large the bucket,
    and each is linked to the least of them.
    """
    masks = [_signed(m) for m in covering_masks()]
    tables = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("v", "bucket"))
    shared = tables.groupBy("v", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("v", "bucket")
    candidates = tables.join(shared, ["v", "bucket"])
    free = [[0] + [_signed(1 << i) for i in range(64) if not (m >> i) & 1] for m in covering_masks()]
    flips = F.element_at(F.array(*[F.array(*map(F.lit, bits)) for bits in free]), F.col("v") + 1)
    posted = candidates.select("v", "fp", F.explode(F.transform(flips, lambda b: F.col("fp").bitwiseXOR(b))).alias("post"))
    met = posted.groupBy("v", "post").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    least = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return least.where("a < b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every document.

    The component of a document has all documents reachable over fingerprints
    that differ in two bits or fewer; its id is the smallest doc_id in it.
    Copies are folded into one fingerprint first and are never paired.

    A missing or empty text, or one without words, has fingerprint zero and is
    linked like any other. A missing doc_id never names a component unless it
    has no other; then the name is missing too. Repeated rows give repeated
    rows, no rows give none, other columns are ignored.
    """
    rows = stored(fingerprints(docs), "simhash")
    named = name_components(rows)
    return rows.join(named.select("fp", "component_id"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def name_components(rows: DataFrame) -> DataFrame:
    """(fp, first, label, component_id) of every distinct fingerprint in (doc_id, fp); ``first`` is its smallest doc_id."""
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    labels = components(near_links(prints))
    grouped = prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    names = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    return stored(grouped.join(names, "label").select("fp", "first", "label", "component_id"), "simhash-components")


def near_duplicate_representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, all columns as they are.

    Of equal ids and fingerprints one row stays. A component without any id
    keeps one of its rows.
    """
    names = docs.columns

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text"):
            found = [fingerprint(t) for t in batch.column("text").to_pylist()]
            doc = pa.StructArray.from_arrays(batch.columns, names=names)
            yield pa.RecordBatch.from_arrays([doc, pa.array(found, pa.int64())], names=["doc", "fp"])

    schema = T.StructType([T.StructField("doc", docs.schema), T.StructField("fp", T.LongType())])
    marked = stored(docs.mapInArrow(mark, schema), "simhash-documents")
    rows = marked.select(F.col("doc.doc_id").alias("doc_id"), "fp")
    heads = name_components(rows).groupBy("label").agg(F.min(F.struct(F.col("first").isNull().alias("last"), "first", "fp")).alias("head"))
    heads = heads.select("head.first", "head.fp")
    met = F.col("doc.doc_id").eqNullSafe(F.col("first")) & (marked["fp"] == heads["fp"])
    kept = marked.join(heads, met, "left_semi")
    repeats = rows.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeats.isEmpty():
        kept = kept.withColumn("id", F.col("doc.doc_id")).dropDuplicates(["id", "fp"])
    return kept.select("doc.*")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
