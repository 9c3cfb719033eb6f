"""Language of a text: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.llm.common import bounded_part, documents, in_bytes, learning_part

SIZES = (2, 3)
BUCKETS = 1 << 16
#: Labelled documents the counts are taken from, about; the matrix is as large for any number of them.
TRAINING_ROWS = 20_000
#: Most cells of the broadcast matrix (4 bytes each).
CELLS = 1 << 24
SMOOTHING = 0.5
UNKNOWN = "und"


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts one after another, and where each text's begin.

    Every text ends in as many zeros as the longest n-gram, so that no n-gram
    spans two texts.
    """
    pad = "\0" * max(SIZES)
    points = np.frombuffer("".join(t.lower() + pad for t in texts).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([len(t.lower()) + len(pad) for t in texts])
    hashes, h = [], np.zeros(len(points), np.uint32)
    for n in range(max(SIZES)):
        h = h * np.uint32(0x01000193)
        h[: len(h) - n] += points[n:] * np.uint32(0x9E3779B1)
        if n + 1 in SIZES:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            hashes.append((mixed >> np.uint32(16)).astype(np.int32))
    return np.stack(hashes, axis=1), np.concatenate([[0], ends[:-1]]).astype(np.int64)


def counts_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language, one row for each that occurs in this task."""
    held: dict[str, np.ndarray] = {}
    for batch in in_bytes(batches, "text", 1 << 20):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            found, _ = grams(texts)
            counted = np.bincount(found.ravel(), minlength=BUCKETS)
            held[lang] = held[lang] + counted if lang in held else counted
    for lang, counted in held.items():
        at = np.flatnonzero(counted)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counted[at], pa.int64())],
            names=["lang", "bucket", "n"])


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of log-probabilities (bucket by language), class priors not included.

    ``labelled`` has text and lang, neither missing. Languages count alike
    whatever their share of the sample. The driver gets sums only: at most one
    number for each bucket and language.
    """
    sums = (
        labelled.select("lang", "text").mapInArrow(counts_by_language, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    langs = [r.lang for r in labelled.select("lang").distinct().orderBy("lang").limit(CELLS // BUCKETS + 1).collect()]
    if len(langs) * BUCKETS > CELLS:
        raise ValueError(f"more than {CELLS // BUCKETS} languages: raise CELLS if executors can hold the matrix")
    counted = np.full((BUCKETS, len(langs)), SMOOTHING)
    if langs:
        got = sums.toArrow()
        column = {lang: k for k, lang in enumerate(langs)}
        at = np.array([column[x] for x in got.column("lang").to_pylist()], dtype=np.int64)
        counted[got.column("bucket").to_numpy(), at] += got.column("n").to_numpy()
    logs = np.log(counted / counted.sum(axis=0, keepdims=True)) if langs else counted
    return langs, np.asfortranarray(logs, dtype=np.float32)


def predict(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its probability."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    if not known or not langs:
        return names, scores
    found, starts = grams([texts[k] for k in known])
    sums = np.zeros((len(known), len(langs)))
    for column in found.T:
        for k in range(len(langs)):
            sums[:, k] += np.add.reduceat(np.take(matrix[:, k], column), starts, dtype=np.float64)
    best = sums.argmax(axis=1)
    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    for row, k in enumerate(known):
        names[k], scores[k] = langs[best[row]], share[row]
    return names, scores


def identify(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """The documents with lang_pred and score, all other columns as they are."""
    names = docs.columns
    if {"lang_pred", "score"} & {c.lower() for c in names}:
        raise ValueError("rename the columns lang_pred and score first")
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def scored(batches):
        for batch in in_bytes(batches, "text", 1 << 20):
            langs_, matrix_ = model.value
            found, score = predict(batch.column("text").to_pylist(), langs_, matrix_)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(score, pa.float64())],
                names=[*names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(scored, schema)


def in_known_language(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """The documents for which a language is found, as they are, whatever their columns are called."""
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text", 1 << 20):
            found, _ = predict(batch.column("text").to_pylist(), *model.value)
            yield batch.filter(pa.array([f != UNKNOWN for f in found], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def held_out(doc_id):
    return learning_part(doc_id, 3) == 1


def fit_language(docs: DataFrame, training_rows: int = TRAINING_ROWS) -> tuple[list[str], np.ndarray]:
    """Learn from documents with text and lang that are not held out."""
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    return train(bounded_part(labelled.select("doc_id", "text", "lang"), "doc_id", training_rows))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    lang_pred is a language that was learned, or ``und`` with score 0 when the
    text is missing or empty, has no letter, or nothing could be learned. The
    score is the posterior probability over equal priors. Ties go to the first
    language by code point. Repeated rows give repeated rows; a missing doc_id
    counts as empty text for the held-out rule. Other columns are ignored.
    """
    langs, matrix = fit_language(docs)
    return identify(docs.select("doc_id", "text"), langs, matrix).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))
