"""Exact duplicates, mixing, language and sharding against plain versions."""

import hashlib
import math
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from aforo.llm import exact, language, mixing, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def small(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Missing values in every column, empty and long texts, repeated rows."""
    return small(spark, [
        (1, "Hello World", "en", "a", 11), (2, "hello world", "en", "b", 11), (2, "hello world", "en", "b", 11),
        (None, "HELLO world", None, None, None), (3, None, "fr", "a", 0), (4, "", "fr", None, 0),
        (5, "É É", "fr", "a", 3), (6, "é é", "fr", "a", 3), (7, "12 34 ..", None, "", 8),
        (8, "word " * 200_000, "en", "b", 1_000_000), (None, None, None, None, None), (None, None, None, None, None),
    ])


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_exact_groups(odd):
    rows = odd.collect()
    got = exact.exact_dedup(odd).collect()
    assert len(got) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(lower(r.text), []).append(r.doc_id)
    digests = {hashlib.sha256(body.encode()).hexdigest(): ids for body, ids in by.items()}
    for r in got:
        ids = digests[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    for digest, ids in digests.items():
        kept = [r for r in got if r.text_sha256 == digest and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_exact_collisions_are_told_apart(odd):
    plain = exact.exact_dedup(odd).collect()
    weak = exact.exact_dedup(odd, lambda body: F.lit("same")).collect()
    assert sorted(map(str, plain)) == sorted(map(str, weak))


def test_nothing_gives_nothing(spark, odd):
    none = odd.limit(0)
    assert exact.exact_dedup(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mixed_documents(none).count() == 0
    assert language.language_id(none).count() == 0
    assert sharding.extendible_shards(none).count() == 0


def test_extra_columns_do_not_clash(odd):
    more = odd.withColumns({c: F.lit(1) for c in ("h", "body", "keep_id", "size", "block", "sid", "depth", "prefix", "copies", "taken", "kept")})
    assert exact.exact_dedup(more).count() == 12
    assert mixing.mix_sources(more).count() == 12
    assert set(mixing.mixed_documents(more).columns) == set(more.columns)
    assert sharding.extendible_shards(more, 100).columns[: len(more.columns)] == more.columns
    assert language.language_id(more).count() == 12


def targets(sizes, share=1.5, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total >= 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            free.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def test_mix_reaches_its_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 9 == 0, None).when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 4)))
    sources = {r.doc_id: r.source for r in docs.collect()}
    rows = mixing.mix_sources(docs).collect()
    sizes, taken, smallest = {}, {}, {}
    for r in rows:
        s = sources[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert r.taken in (0, r.size, 2 * r.size) and len(r.shards) == r.copies
    want = targets(sizes)
    for r in rows:
        s = sources[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.025 * sizes[s] + 20
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken, r.shards) for r in rows) == sorted((r.doc_id, r.taken, r.shards) for r in again)
    copies = {r["doc_id"]: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in rows if r.copies}


def test_mix_in_small_blocks(spark, sf, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 2_000)
    monkeypatch.setattr(mixing, "FINE_WORDS", 500)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 10_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    sources = {r.doc_id: r.source for r in docs.collect()}
    rows = mixing.mix_sources(docs).collect()
    sizes, taken, per_shard = {}, {}, {}
    for r in rows:
        s = sources[r.doc_id]
        sizes[s], taken[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken
        for k in r.shards:
            per_shard[k] = per_shard.get(k, 0) + r.size
    for s, want in targets(sizes).items():
        assert abs(taken[s] - want) <= 0.03 * sizes[s]
    assert len(per_shard) > 4


def test_tree_deals_exact_quotas(spark):
    quotas = spark.createDataFrame([(0, 37), (1, 5), (2, 0), (3, 22)], "sid long, n long")
    rows = mixing.splitting_tree(quotas, 3).collect()
    by_source, by_shard = {}, {}
    for r in rows:
        by_source[r.sid] = by_source.get(r.sid, 0) + r.n
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.n
    assert by_source == {0: 37, 1: 5, 2: 0, 3: 22} and set(by_shard.values()) == {8}


def test_language_of_held_out_texts(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.language_id(docs).collect()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_unknown(odd):
    got = language.language_id(odd).collect()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id}
    for r in got:
        if r.doc_id and not re.search(r"[^\W\d_]", texts[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        assert r.lang_pred in ("und", "en", "fr")


def test_naive_bayes_by_hand():
    import numpy as np
    texts = ["aab", "Zé"]
    found, starts = language.grams(texts)
    assert starts.tolist() == [0, 6] or starts.tolist() == [0, 3 + max(language.SIZES)]
    alone, _ = language.grams(["zé"])
    assert np.array_equal(found[starts[1]:], alone)


@pytest.mark.parametrize("limit", [20_000, 3_000])
def test_shards_fit(spark, sf, limit):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.extendible_shards(docs, limit).select("doc_id", "shard", "shard_bytes", "shard_rows").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(sharding.SQL.replace(str(sharding.SHARD_BYTES), str(limit))).fetchall()
    assert sorted(map(tuple, rows)) == sorted(want)
    assert all(r.shard_bytes <= limit or r.shard_rows == 1 for r in rows)
    assert len({r.shard for r in rows}) > 10


def test_equal_rows_are_split(spark):
    docs = small(spark, [(1, "x" * 100, "en", "a", 100)] * 50 + [(k, "y" * 40, "en", "a", 40) for k in range(2, 40)])
    rows = sharding.extendible_shards(docs, 500).select("doc_id", "shard", "shard_bytes", "text").collect()
    held = {}
    for r in rows:
        held[r.shard] = held.get(r.shard, 0) + len(r.text)
    assert len(rows) == 88 and max(held.values()) <= 500
    assert all(held[r.shard] == r.shard_bytes for r in rows)
