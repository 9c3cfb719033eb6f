"""Phrase collocations from sorted count streams, merged in step."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm.common import discard, documents, give_back, in_bytes, stored

LEAST = 10
WORDS = 3
KEEP_SHARE = 50
TOP = 2000
SCALE = 1_000_000
#: Text whose words are numbered and counted together in a task.
CHUNK_BYTES = 2 << 20
#: Bits of the filter that passes on frequent phrases; its size does not grow with the input.
FILTER_BITS = 1 << 24
#: Phrases whose checksums are computed together.
MARKED = 1 << 14

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 2 where a piece ends, 1 at the blanks between words, 0 inside words.
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2
_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")


class Numbered:
    """The words of some texts as numbers in the order of (language, word), and the piece each stands in."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        # Every text gets a line feed behind it, so that no piece goes on in the next text.
        joined = pc.binary_join_element_wise(texts, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
        whole = np.frombuffer(b"".join(joined.to_pylist()), np.uint8)
        kind = _KIND[whole]
        inside = kind == 0
        edges = np.flatnonzero(np.diff(inside, prepend=False))  # begins and ends in turn: a text ends with a line feed
        begins, ends = edges[0::2], edges[1::2]
        text_of = np.searchsorted(np.cumsum(sizes + 1), begins, side="right")
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), begins)
        bounds = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(_LOWER[whole[inside]])])
        coded = words.dictionary_encode()
        order, word = _ranked(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        coded = langs.dictionary_encode()
        lang_order, lang = _ranked(coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        pairs, self.word = np.unique(lang[text_of] * max(1, len(order)) + word, return_inverse=True)
        self.langs = lang_order.take(pa.array(pairs // max(1, len(order))))
        self.words = order.take(pa.array(pairs % max(1, len(order))))


def _ranked(values: pa.Array, index: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The values in byte order, and ``index`` renumbered to it."""
    order = pc.array_sort_indices(values).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return values.take(pa.array(order)), rank[index]


def _marks(langs: pa.Array, phrases: pa.Array, bits: int) -> np.ndarray:
    """A place in the filter for each phrase: a checksum of language and phrase. What meets by chance is counted in vain, not wrongly."""
    parts = [_marks_of(langs.slice(k, MARKED), phrases.slice(k, MARKED), bits) for k in range(0, len(phrases), MARKED)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _marks_of(langs: pa.Array, phrases: pa.Array, bits: int) -> np.ndarray:
    joined = pc.binary_join_element_wise(langs, phrases, pa.scalar(b"\0", pa.large_binary())).cast(pa.large_binary())
    bounds = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)
    data = np.frombuffer(joined.buffers()[2], np.uint8) if len(joined) else np.zeros(0, np.uint8)
    # Sums of bytes times powers of an odd number, modulo 2**64: differences of one running sum.
    size = np.diff(bounds)
    within = np.arange(bounds[0], bounds[-1]) - np.repeat(bounds[:-1], size)
    powers = np.ones(int(size.max(initial=0)) + 1, np.uint64)
    powers[1:] = np.uint64(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(powers)
    sums = np.zeros(len(within) + 1, np.uint64)
    np.cumsum((data[bounds[0]:bounds[-1]].astype(np.uint64) + np.uint64(1)) * powers[within], out=sums[1:])
    h = sums[bounds[1:] - bounds[0]] - sums[bounds[:-1] - bounds[0]]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(bits)).astype(np.int64)


def _phrases(numbered: Numbered, grams: np.ndarray) -> pa.Array:
    """The phrases of rows of word numbers, joined by single spaces."""
    columns = [numbered.words.take(pa.array(grams[:, k])) for k in range(grams.shape[1])]
    return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if len(columns) > 1 else columns[0]


def _runs(numbered: Numbered, order: int, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of ``order`` words as rows of word numbers in sorted order, and how often each occurs.

    ``allowed`` has the filter's bits: only phrases whose first and last
    ``order - 1`` words may be frequent are counted.
    """
    word, piece = numbered.word, numbered.piece
    starts = np.flatnonzero(piece[:len(piece) - order + 1] == piece[order - 1:]) if len(piece) >= order else np.zeros(0, np.int64)
    size = max(1, len(numbered.words))

    def rows(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases from ``at``, as numbers in sorted order, grown word by word so that they stay small."""
        own = word[at]
        firsts = None
        for k in range(1, length):
            keys = own * size + word[at + k]
            _, firsts, own = np.unique(keys, return_index=True, return_inverse=True)
        if firsts is None:
            _, firsts, own = np.unique(own, return_index=True, return_inverse=True)
        return np.stack([word[at[firsts] + k] for k in range(length)], axis=1), own

    if allowed is not None and len(starts):
        at = np.unique(np.concatenate([starts, starts + 1]))
        shorter, own = rows(at, order - 1)
        marks = _marks(numbered.langs.take(pa.array(shorter[:, 0])), _phrases(numbered, shorter), len(allowed) * 8)
        good = ((allowed[marks >> 3] >> (marks & 7).astype(np.uint8)) & 1).astype(bool)[own]
        where = np.searchsorted(at, starts)
        starts = starts[good[where] & good[np.searchsorted(at, starts + 1)]]
    if not len(starts):
        return np.zeros((0, order), np.int64), np.zeros(0, np.int64)
    grams, own = rows(starts, order)
    return grams, np.bincount(own, minlength=len(grams))


def _counted(orders: tuple[int, ...], allowed, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = None if allowed is None else np.frombuffer(allowed.value, np.uint8)

    def counts(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).combine_chunks()
        numbered = Numbered(whole.column("text").combine_chunks(), whole.column("lang").combine_chunks())
        for order in orders:
            grams, times = _runs(numbered, order, bits)
            for begin in range(0, len(grams), 1 << 16):
                own = grams[begin:begin + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [numbered.langs.take(pa.array(own[:, 0])).cast(pa.binary()).cast(pa.string()),
                     _phrases(numbered, own).cast(pa.binary()).cast(pa.string()), pa.array(times[begin:begin + (1 << 16)], pa.int64())],
                    names=["lang", "phrase", "times"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in _short(in_bytes(batches, "text")):
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if size >= CHUNK_BYTES:
            yield from counts(held)
            held, size = [], 0
    if held:
        yield from counts(held)
    give_back()


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same pieces; a text of more than a chunk becomes several rows, cut where a piece ends."""
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        if batch.num_rows > 1 or (pc.sum(pc.binary_length(text)).as_py() or 0) <= CHUNK_BYTES:
            yield pa.RecordBatch.from_arrays([batch.column("lang"), text], names=["lang", "text"])
            continue
        whole, begin = text[0].as_py(), 0
        while begin < len(whole):
            found = _BREAK.search(whole, begin + CHUNK_BYTES)
            end = found.end() if found else len(whole)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([whole[begin:end]], pa.binary())], names=["lang", "text"])
            begin = end


def phrase_counts(docs: DataFrame, orders: tuple[int, ...], least: int, allowed=None) -> DataFrame:
    """(lang, phrase, f, words) of the phrases of ``orders`` words that occur ``least`` times in a language.

    All rarer phrases of a language are one row without a phrase; ``words`` adds up f over single words, rare ones included.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    runs = rows.mapInArrow(partial(_counted, orders, allowed), "lang string, phrase string, times long")
    sums = runs.groupBy("lang", "phrase").agg(F.sum("times").alias("f"))
    if 1 not in orders:
        return stored(sums.where(F.col("f") >= least).withColumn("words", F.lit(0).cast("long")), "phrases")
    single = F.when(~F.contains("phrase", F.lit(" ")), F.col("f"))
    named = F.when(F.col("f") >= least, F.col("phrase"))
    return stored(sums.groupBy("lang", named.alias("phrase")).agg(F.sum("f").alias("f"), F.sum(single).alias("words")), "phrases")


def _bits(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filter's words of 64 bits that a task sets."""
    mine = np.zeros(bits // 64, np.uint64)
    for batch in batches:
        marks = _marks(batch.column("lang").cast(pa.binary()).cast(pa.large_binary()), batch.column("phrase").cast(pa.binary()).cast(pa.large_binary()), bits)
        np.bitwise_or.at(mine, marks >> 6, np.uint64(1) << (marks & 63).astype(np.uint64))
    at = np.flatnonzero(mine)
    for begin in range(0, len(at), 1 << 16):
        own = at[begin:begin + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(mine[own].view(np.int64))], names=["at", "bits"])


def phrase_filter(phrases: DataFrame, bits: int = FILTER_BITS):
    """A broadcast of ``bits`` bits in which the places of all ``phrases`` are set. At most bits / 64 rows come to the driver."""
    spark = phrases.sparkSession
    rows = phrases.mapInArrow(partial(_bits, bits), "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    whole = np.zeros(bits // 64, np.int64)
    whole[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return spark.sparkContext.broadcast(whole.tobytes())


def collocations(docs: DataFrame, least: int = LEAST, max_words: int = WORDS, keep_share: int = KEEP_SHARE, top: int = TOP) -> DataFrame:
    """The phrases of 2 to ``max_words`` words whose words attract each other most, by language.

    Columns: lang, rank, phrase, a, l, r, n, score. Texts are lower-cased (A-Z),
    split into pieces at punctuation and line ends, and these into words at
    blanks. A candidate occurs ``least`` times; its score is the least over its
    cuts of a * a / (l * r), in millionths, rounded down. A candidate goes if a
    longer one that contains it occurs ``keep_share`` per cent as often.

    Counts: a task numbers the words of some megabytes in sorted order, sorts
    the phrases as numbers and adds up runs of equal ones; what leaves it is
    a sorted stream of distinct phrases, added up once more behind the
    shuffle, where those below ``least`` end. Longer phrases are counted in a
    further pass over the texts and only where a filter of fixed size says that
    the words without the last and without the first may be frequent; a phrase
    never occurs more often than its parts, so none is missed. A filter that
    is full passes all and costs only time.

    Left counts: cuts in the order of their first words meet the counts in the
    order of phrases (prefix order) in a sort-merge join. Right counts: cuts
    in the order of the rest (suffix order) meet them in another. Extension
    counts: longer candidates give the most of each phrase they contain, met
    the same way. Nothing is looked up in a hash table of phrases, a skewed
    first or last word is split by the engine, and no list of extensions is ever gathered.

    A missing text is empty, a missing language counts as ``und``. Ties follow
    the smaller cut, then the count and the bytes of the phrase. Rows without
    words, and no rows, give nothing; repeated rows count each time; other
    columns are ignored.
    """
    tables = [phrase_counts(docs, (1, 2), least)]
    words = tables[0].groupBy("lang").agg(F.sum("words").alias("n"))
    for order in range(3, max_words + 1):
        allowed = phrase_filter(tables[-1].where(F.contains("phrase", F.lit(" "))))
        tables.append(phrase_counts(docs, (order,), least, allowed))
        allowed.unpersist()
    streams = reduce(DataFrame.unionByName, tables).where("phrase IS NOT NULL")
    candidates = streams.where(F.contains("phrase", F.lit(" "))).withColumn("size", F.size(F.split("phrase", " ")))
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))
    lefts = streams.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = streams.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(lefts.hint("merge"), ["lang", "first"]).join(rights.hint("merge"), ["lang", "rest"])
    wide = "CAST({} AS DECIMAL(38, 0))"
    score = F.expr(f"({wide.format('a')} * {wide.format('a')} * {SCALE}) div ({wide.format('l')} * {wide.format('r')})")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("size").alias("size"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "size", "cut.score", "cut.l", "cut.r")
    # The phrases of two words and more inside a longer candidate.
    inner = F.expr(
        "explode(flatten(transform(sequence(2, size - 1), m -> transform(sequence(0, size - m), "
        "s -> array_join(slice(split(phrase, ' '), s + 1, m), ' ')))))")
    longer = scored.where("size > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    alone = scored.join(longer.hint("merge"), ["lang", "phrase"], "left").where(f"most IS NULL OR 100 * most < {keep_share} * a")
    place = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)").cast("long")
    ranked = alone.withColumn("rank", place).where(F.col("rank") <= top)
    found = stored(ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    discard(*tables)
    return found


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM split
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split WHERE len(w) > 1
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM split WHERE len(w) > 2
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT lang, phrase, size, a, w, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.w, c.k, x.f AS l, y.f AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, inner_phrase, max(a) AS most
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inner_phrase FROM candidates WHERE size = 3)
  GROUP BY ALL
), alone AS (
  SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.inner_phrase = s.phrase
  WHERE g.most IS NULL OR 100 * g.most < 50 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM alone)
JOIN totals USING (lang) WHERE rank <= 2000
"""
