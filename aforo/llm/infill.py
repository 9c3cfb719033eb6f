"""Fill-in-middle rows with piece tables: descriptors over the text and a buffer of sentinels."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.llm.common import documents, in_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The second immutable buffer of every table.
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Per cent of the documents that are rearranged, and of those the ones with the suffix in front.
RATE, SUFFIX_FIRST = 100, 50
SALT = "7"
#: Where each part of the original (prefix, middle, suffix) stands among the three parts of an arrangement.
ORDERS = {"psm": (0, 2, 1), "spm": (1, 2, 0)}
MARKS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


class Piece(NamedTuple):
    """Bytes ``start`` to ``end`` of buffer ``source``: 0 is the text, 1 the sentinels."""

    source: int
    start: int
    end: int


def cut(table: list[Piece], at: int) -> list[Piece]:
    """The same content with a boundary after ``at`` bytes; only the descriptor that holds it is split."""
    out, passed = [], 0
    for piece in table:
        size = piece.end - piece.start
        if passed < at < passed + size:
            middle = piece.start + at - passed
            out += [Piece(piece.source, piece.start, middle), Piece(piece.source, middle, piece.end)]
        else:
            out.append(piece)
        passed += size
    return out


def arrange(parts: list[list[Piece]], form: str) -> list[Piece]:
    """Prefix, middle and suffix, each a table, in the order of ``form`` and each behind its sentinel."""
    placed: list[list[Piece]] = [[], [], []]
    for part, place in zip(parts, ORDERS[form]):
        placed[place] = part
    out = []
    for mark, part in zip(MARKS[form], placed):
        start = SENTINELS.index(mark)
        out += [Piece(1, start, start + len(mark)), *part]
    return out


def restore(output: bytes, form: str) -> list[Piece]:
    """The original as descriptors over ``output``: sentinels are left out and the permutation is inverted.

    No part holds a sentinel (such texts stay plain), so the first occurrence of each is the one that was put in.
    """
    if form == "plain":
        return [Piece(0, 0, len(output))]
    begins, ends, at = [], [], 0
    for mark in MARKS[form]:
        found = output.index(mark, at)
        ends.append(found)
        at = found + len(mark)
        begins.append(at)
    parts = list(zip(begins, [*ends[1:], len(output)]))
    return [Piece(0, *parts[place]) for place in ORDERS[form]]


def streamed(table: list[Piece], text: bytes) -> Iterator[memoryview]:
    """The content, one descriptor after the other, without a copy of it."""
    buffers = (memoryview(text), memoryview(SENTINELS))
    return (buffers[p.source][p.start:p.end] for p in table)


def digest(table: list[Piece], text: bytes) -> str:
    seen = hashlib.sha256()
    for part in streamed(table, text):
        seen.update(part)
    return seen.hexdigest()


def code_points(text: bytes, begin: int, end: int) -> int:
    """Code points of a part of UTF-8 text: its bytes that do not continue a character."""
    own = np.frombuffer(text, np.uint8, end - begin, begin)
    return int(np.count_nonzero((own & 0xC0) != 0x80))


def plan(doc_id: object, text: bytes, rate: int, suffix_first: int, salt: str) -> tuple[int, str, int, int]:
    """Lines of the text, the form it takes, and the bytes after which prefix and middle end."""
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    ends = breaks if not text or text.endswith(b"\n") else np.append(breaks, len(text))
    n = len(ends)
    drawn = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[k:k + 8], 16) for k in range(0, 32, 8))
    if not text or any(mark in text for mark in MARKS["psm"]) or h3 % 100 >= rate:
        return n, "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, "spm" if h4 % 100 < suffix_first else "psm", *(int(ends[k - 1]) if k else 0 for k in (low, high))


ROWS = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()), T.StructField("output_sha256", T.StringType()),
])


def _rows(rate: int, suffix_first: int, salt: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_bytes(batches, "text"):
        out: list[tuple] = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            text = text or b""
            n, form, low, high = plan(doc_id, text, rate, suffix_first, salt)
            pieces = [Piece(0, 0, len(text))]
            if form == "plain":
                out.append((n, form, None, None, text, digest(pieces, text)))
                continue
            pieces = cut(cut(pieces, low), high)
            pieces = arrange([[p for p in pieces if lo <= p.start and p.end <= hi and p.start < p.end]
                              for lo, hi in ((0, low), (low, high), (high, len(text)))], form)
            out.append((n, form, code_points(text, 0, low), code_points(text, low, high),
                        b"".join(streamed(pieces, text)), digest(pieces, text)))
        n, form, prefix, middle, output, sha = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
             pa.array(output, pa.binary()).cast(pa.string()), pa.array(sha)], names=["doc_id", *ROWS.names])


def fill_in_middle(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, salt: str = SALT) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output, output_sha256.

    A text is cut after two of its ``n`` lines, drawn by a hash of salt and id,
    into prefix, middle and suffix. Form ``psm`` is prefix, suffix, middle and
    ``spm`` is suffix, prefix, middle, each part behind its sentinel; ``plain``
    is the text as it is: if it is empty, holds a sentinel, or is not among the
    ``rate`` per cent. Nothing is shuffled and a task holds about two megabytes of text,
    or one text that is longer.

    A missing text is empty; a missing doc_id is drawn as an empty one. Repeated
    rows give repeated rows, no rows give none, other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType
    fields = T.StructType([T.StructField("doc_id", kind), *ROWS.fields])
    return docs.select("doc_id", "text").mapInArrow(partial(_rows, rate, suffix_first, salt), fields)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_bytes(batches, "output"):
        texts, digests = [], []
        for output, form in zip(batch.column("output").cast(pa.binary()).to_pylist(), batch.column("form").to_pylist()):
            table = restore(output or b"", form)
            texts.append(b"".join(streamed(table, output or b"")))
            digests.append(digest(table, output or b""))
        kept = [batch.column(k) for k in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())],
                                         names=[*batch.schema.names, "restored", "restored_sha256"])


def restored(rows: DataFrame) -> DataFrame:
    """Rows of ``fill_in_middle`` with the text rebuilt from ``output`` and ``form`` alone, and its SHA-256."""
    fields = T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType()), T.StructField("restored_sha256", T.StringType())])
    return rows.mapInArrow(_restored, fields)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored(fill_in_middle(documents(spark, sf_dir))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), hashed AS (
  SELECT doc_id, body, lines, len(lines) AS n, CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
         CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4
  FROM drawn
), cuts AS (
  SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS low, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS high,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), parts AS (
  SELECT *, array_to_string(lines[1:low], '') AS prefix, array_to_string(lines[low + 1:high], '') AS middle,
         array_to_string(lines[high + 1:], '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
