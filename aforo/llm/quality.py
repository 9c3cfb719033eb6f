"""Quality of a text by the votes of labelled neighbours in a latent-semantic space."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm.common import bounded_part, documents, in_bytes, learning_part, table

#: Hashed features: character n-grams, then word shapes and repetition.
GRAMS, SHAPES = 4096, 1024
FEATURES = GRAMS + SHAPES
DIMENSIONS = 64
#: Labelled documents the space is fitted on, and those that vote, about. Both bound what is broadcast.
FIT_ROWS = 2_000
VOTERS = 8_000
NEIGHBOURS = 15
SEED = 6
#: Documents whose products are computed together.
BLOCK = 256

_SHAPE = bytes(
    ord("d") if 48 <= c <= 57 else ord("X") if 65 <= c <= 90 else ord("x") if 97 <= c <= 122 or c >= 128 else c
    for c in range(256)
)
_RUNS = re.compile(rb"(.)\1+")


def features(texts: list[str | None]) -> np.ndarray:
    """Counts of hashed features, one row for each text; the whole text counts."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    shapes: dict[bytes, int] = {}
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        if not raw:
            continue
        b = np.frombuffer(raw.lower() + b"  ", np.uint8).astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out[row, :GRAMS] = np.bincount((h >> np.uint32(20)).astype(np.int64), minlength=GRAMS)
        own = raw.split()
        for w in set(s := raw.translate(_SHAPE).split()):
            if w not in shapes:
                shapes[w] = _slot(_RUNS.sub(rb"\1", w))
        found = np.fromiter(map(shapes.get, s, repeat(0)), np.int64, len(s))
        out[row, GRAMS:] = np.bincount(found, minlength=SHAPES)
        # How much of the text repeats: words equal to one of the two before, and words seen before, in steps of an eighth.
        near = sum(a == c or b_ == c for a, b_, c in zip(own, own[1:], own[2:])) / max(1, len(own) - 2)
        distinct = len(set(own)) / max(1, len(own))
        out[row, GRAMS + 1 + int(near * 7.99)] += len(own)
        if distinct < 0.5:
            out[row, GRAMS + 16 + int(distinct * 16)] += len(own)
    return out


def _slot(shape: bytes) -> int:
    """The feature of a shape; the first 32 are those of repetition."""
    h = 2166136261
    for c in shape:
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return 32 + h % (SHAPES - 32)


class Space:
    """Weights of features and the projection to the latent dimensions."""

    def __init__(self, logs: np.ndarray):
        seen = (logs > 0).sum(axis=0)
        self.weight = (np.log((1 + len(logs)) / (1 + seen)) + 0.3).astype(np.float32)
        x = self.weigh(logs)
        random = np.random.default_rng(SEED)
        size = min(DIMENSIONS + 16, *x.shape)
        basis = np.linalg.qr(x @ (x.T @ (x @ random.standard_normal((x.shape[1], size), np.float32))))[0]
        _, values, right = np.linalg.svd(basis.T @ x, full_matrices=False)
        kept = values[:DIMENSIONS] > 1e-6
        self.axes = np.ascontiguousarray(right[:DIMENSIONS][kept].T.astype(np.float32))

    def weigh(self, logs: np.ndarray) -> np.ndarray:
        x = logs * self.weight
        for part in (slice(0, GRAMS), slice(GRAMS, FEATURES)):
            x[:, part] /= np.maximum(np.linalg.norm(x[:, part], axis=1, keepdims=True), 1e-9)
        return x

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = self.weigh(np.log1p(counts)) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def vote(vectors: np.ndarray, voters: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The similarity-weighted share of label 1 among the nearest voters; without any similarity their mean."""
    if not len(voters):
        return np.full(len(vectors), 0.5)
    products = vectors @ voters.T
    k = min(NEIGHBOURS, len(voters))
    near = np.argpartition(-products, k - 1, axis=1)[:, :k] if k < len(voters) else np.tile(np.arange(k), (len(vectors), 1))
    weight = np.maximum(np.take_along_axis(products, near, axis=1), 0).astype(np.float64) ** 4
    total = weight.sum(axis=1)
    share = (weight * labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
    return np.where(total > 1e-9, share, labels.mean())


def held_out(doc_id):
    return learning_part(doc_id, 5) == 0


def marks_to_learn(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the rows that are not held out; a repeated or contradicted label counts by its mean."""
    return (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.round(F.avg(label)).cast("int").alias("label"))
    )


def labelled(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the marked documents. ``marks`` is a sample of bounded size, so that no text is moved."""
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("doc_id", "text", "label")


def fit_quality(docs: DataFrame, labels: DataFrame) -> tuple[Space | None, np.ndarray, np.ndarray]:
    """The space and the voters' vectors and labels, from a sample of bounded size.

    The space is fitted at the driver on FIT_ROWS feature vectors. The voters
    are projected by tasks, so the driver gets 64 numbers for each.
    """
    known = labelled(docs, bounded_part(marks_to_learn(labels, "quality"), "doc_id", VOTERS))
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text", 1 << 20):
            # Logarithms: the counts of a very long text are beyond this type.
            x = np.log1p(features(batch.column("text").to_pylist())).astype(np.float16)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], names=["x"])

    fitting = bounded_part(known, "doc_id", FIT_ROWS, "fit").select("text").mapInArrow(count, "x binary").toArrow().column("x")
    if not len(fitting):
        return None, np.zeros((0, DIMENSIONS), np.float32), np.zeros(0)
    space = Space(np.stack([np.frombuffer(x.as_buffer(), np.float16).astype(np.float32) for x in fitting]))
    shared = spark.sparkContext.broadcast(space)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text", 1 << 20):
            v = shared.value.vectors(features(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r.tobytes() for r in v], pa.binary()), batch.column("label")], names=["doc_id", "v", "label"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = known.mapInArrow(project, f"doc_id {kind}, v binary, label int").orderBy("doc_id", "v").toArrow()
    vectors = np.stack([np.frombuffer(x.as_buffer(), np.float32) for x in got.column("v")])
    return space, vectors, got.column("label").to_numpy().astype(np.float64)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    The score is the share of label 1 among the nearest labelled documents,
    weighted by the fourth power of the cosine. A missing or empty text is
    near to none and gets the mean label. Missing labels teach nothing, several
    of one document count by their mean; without any label all scores are 0.5.
    Repeated rows give repeated rows, no rows give none, other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, voters, marks = model.value
        for batch in in_bytes(batches, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            scores = [np.full(len(texts), 0.5)] if space is None else [
                vote(space.vectors(features(texts[k:k + BLOCK])), voters, marks) for k in range(0, len(texts), BLOCK)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores), pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
