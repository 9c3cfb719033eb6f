"""Find and cut benchmark passages in documents with an FM-index per shard of text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.llm.common import UPPER, documents, in_bytes, table
from aforo.llm.fm_index import LONGEST, FMIndex

WINDOW = 10
#: Text of a shard, and of the benchmark items broadcast together. A larger benchmark takes several passes.
SHARD_BYTES = 2 << 20
ITEM_BYTES = 8 << 20
#: Words are runs of 0-9, a-z and everything beyond ASCII, after lower-casing A-Z; all other bytes part them.
_PART = bytes(
    c + 32 if chr(c) in UPPER else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_PART).split()


class Windows:
    """The distinct windows of some benchmark items, by length, and the items each belongs to.

    ``groups`` holds (length, windows as sorted rows of word numbers, where each window's owners begin, owners).
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        by_size: dict[int, list[tuple[np.ndarray, int]]] = {}
        for name, text in items:
            own = words(text)
            if own:
                own = np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own), np.int32, len(own))
                size = min(window, len(own))
                by_size.setdefault(size, []).append((np.lib.stride_tricks.sliding_window_view(own, size), number[name]))
        self.groups = []
        for size, parts in sorted(by_size.items()):
            rows = np.concatenate([w for w, _ in parts])
            owners = np.repeat(np.array([k for _, k in parts], np.int32), [len(w) for w, _ in parts])
            order = np.lexsort((owners, *rows.T[::-1]))
            rows, owners = rows[order], owners[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            fresh = new.copy()
            fresh[1:] |= owners[1:] != owners[:-1]  # an item may have a window twice
            begins = np.append(np.cumsum(fresh)[new] - 1, fresh.sum())
            self.groups.append((size, rows[new], begins, owners[fresh]))


def search_shard(texts: list[str | None], windows: Windows) -> list[tuple[int, np.ndarray, list[str]]]:
    """For each text: its number of words, which of them are hit, and the items that hit."""
    get, symbols, sizes = windows.vocabulary.get, [], []
    for text in texts:
        own = words(text)
        sizes.append(len(own))
        symbols.append(np.fromiter(map(get, own, repeat(0)), np.int32, len(own)))
        symbols.append(np.zeros(1, np.int32))
    sequence = np.concatenate(symbols)
    begins = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)])
    # Words that no item has cannot be in a window: a run of them is one separator.
    kept = np.ones(len(sequence), bool)
    kept[1:] = (sequence[1:] != 0) | (sequence[:-1] != 0)
    kept[-1] = True
    positions = np.flatnonzero(kept)
    change = np.zeros(len(sequence) + 1, np.int64)
    items: dict[int, set[int]] = {}
    # A sequence beyond one index (one huge text) is indexed in pieces that overlap by a window.
    overlap = max((size for size, *_ in windows.groups), default=1)
    for begin in range(0, len(positions), LONGEST - 4 - overlap):
        piece = positions[begin:begin + LONGEST - 4]
        index = FMIndex(np.append(sequence[piece], np.int32(0)), len(windows.vocabulary))
        for size, patterns, firsts, owners in windows.groups:
            low, high = index.search(patterns)
            met = np.flatnonzero(low < high)
            if not len(met):
                continue
            times = (high - low)[met]
            which = np.repeat(met, times)
            rows = np.repeat(low[met], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = piece[index.locate(rows)]
            np.add.at(change, at, 1)
            np.add.at(change, at + size, -1)
            doc = np.searchsorted(begins, at, side="right") - 1
            for d, w in np.unique(np.stack([doc, which]), axis=1).T:
                items.setdefault(int(d), set()).update(owners[firsts[w]:firsts[w + 1]].tolist())
    hit = np.cumsum(change) > 0
    return [
        (size, hit[begins[k]:begins[k] + size], [windows.names[i] for i in sorted(items.get(k, ()))])
        for k, size in enumerate(sizes)
    ]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in blocks of bounded size, one at a time; its size is asked for before anything is fetched."""
    items = benchmark.where("text IS NOT NULL").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // ITEM_BYTES
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield [(r.item_id, r.text) for r in items.where(block == k).collect()]


HITS = T.StructType([
    T.StructField("_n_words", T.LongType()), T.StructField("_n_hit", T.LongType()), T.StructField("_hit", T.BinaryType()),
    T.StructField("_items", T.ArrayType(T.StringType())),
])


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with _n_words, _n_hit, _hit (a bit for each word) and _items (ids of the items that occur, sorted)."""
    spark, found = docs.sparkSession, docs
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(Windows(block, window))
        found = _pass(found, shared, docs.schema)
    return found


def _pass(rows: DataFrame, shared, plain: T.StructType) -> DataFrame:
    """One block of items: hits are added to those of earlier blocks."""
    names = plain.names
    earlier = len(rows.columns) > len(names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in in_bytes(batches, "text", SHARD_BYTES):
            got = search_shard(batch.column("text").to_pylist(), windows)
            bits, items = [np.packbits(h).tobytes() for _, h, _ in got], [i for _, _, i in got]
            if earlier:
                before = zip(batch.column("_hit").to_pylist(), batch.column("_items").to_pylist())
                merged = [(bytes(x | y for x, y in zip(a, b)), sorted({*i, *j})) for (a, i), b, j in zip(before, bits, items)]
                bits, items = [m[0] for m in merged], [m[1] for m in merged]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[: len(names)], pa.array([n for n, _, _ in got], pa.int64()),
                pa.array([int.from_bytes(b, "big").bit_count() for b in bits], pa.int64()),
                pa.array(bits, pa.binary()), pa.array(items, pa.list_(pa.string())),
            ], names=[*names, *HITS.names])

    return rows.mapInArrow(search, T.StructType([*plain.fields, *HITS.fields]))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    Words are runs of letters, digits and anything beyond ASCII; A-Z is
    lower-cased. A window is ten consecutive words of an item, or all of a
    shorter one; a word inside an occurrence of a window is hit. A missing text
    has no words; an item without words or text has no window; an item without
    id counts as one with an empty id, and rows of the same id as one item.
    Repeated documents give repeated rows, no documents give none, an empty
    benchmark hits nothing. Other columns are ignored.
    """
    return find_passages(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.size("_items") > 0).alias("contaminated"))


def cut_spans(text: str, hit: np.ndarray) -> str:
    """``text`` without the hit words and what stands between them; a cut leaves a line break."""
    raw = text.encode("utf-8", "replace")
    inside = np.frombuffer(raw.translate(_PART), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    change = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    pieces, at = [], 0
    for first, last in zip(change[::2], change[1::2]):
        pieces.append(raw[at:starts[first]])
        at = ends[last - 1]
    pieces.append(raw[at:])
    return b"\n".join(pieces).decode("utf-8")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with benchmark passages cut out of text; a text of nothing else leaves.

    n_chars, where there is such a column, follows the text. Documents without
    a passage pass unchanged, also those without text.
    """
    schema = docs.schema
    # Under names of their own no column can be taken for one of the search's.
    names = [n if n == "text" else f"c{k}" for k, n in enumerate(docs.columns)]
    sized = next((names[k] for k, n in enumerate(docs.columns) if n == "n_chars"), None)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text"):
            rows = zip(batch.column("text").to_pylist(), batch.column("_n_words").to_pylist(), batch.column("_hit").to_pylist())
            texts, stays = [], []
            for text, size, bits in rows:
                hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool) if size else np.zeros(0, bool)
                stays.append(not size or not hit.all())
                texts.append(cut_spans(text, hit) if hit.any() and stays[-1] else text)
            columns = dict(zip(names, batch.columns))
            columns["text"] = pa.array(texts, columns["text"].type)
            if sized:
                old = columns[sized]
                changed = [len(t) if t is not None and t is not u and t != u else None for t, u in zip(texts, batch.column("text").to_pylist())]
                columns[sized] = pa.array([n if c is None else c for n, c in zip(old.to_pylist(), changed)], old.type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=schema.names).filter(pa.array(stays, pa.bool_()))

    return find_passages(docs.toDF(*names), benchmark).mapInArrow(cut, schema)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM (
    SELECT item, w, least({WINDOW}, len(w)) AS size, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0
  ) AS x
), dw AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bw) AS s WHERE len(w) >= size
  ) AS x
), met AS (SELECT doc_id, item, i, dw.size AS size FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) AS x GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM met) AS x GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""
