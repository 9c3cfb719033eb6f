"""Held-out labels, letters, benchmark blocks, and the pipeline's stages against plain versions."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aforo.llm import decontaminate, language, quality, sharding, simhash, toxicity
from aforo.llm.common import table

CLASHING = ["score", "lang_pred", "shard", "shard_bytes", "shard_rows", "_hit", "_n_words", "_items", "doc", "fp", "key", "c0", "id", "size", "label"]


@pytest.mark.parametrize("op", ["quality", "toxic"])
def test_held_out_labels_teach_nothing(spark, sf, monkeypatch, op):
    """Also where the bounds of the samples bite."""
    for module, name, value in ((quality, "VOTERS", 40), (quality, "FIT_ROWS", 30), (toxicity, "TRAINING_ROWS", 30),
                                (toxicity, "CALIBRATION_ROWS", 20), (toxicity, "EPOCHS", 1)):
        monkeypatch.setattr(module, name, value)
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = quality.held_out(F.col("doc_id"))
    assert labels.where(held).count() > 10
    flipped = labels.withColumns({c: F.when(held, 1 - F.col(c)).otherwise(F.col(c)).cast("int") for c in ("quality", "toxic")})
    more = labels.unionByName(labels.where(held)).unionByName(flipped.where(held))
    run = quality.quality if op == "quality" else toxicity.toxicity
    scores = [sorted((r.doc_id, r.score) for r in run(docs, x).collect()) for x in (labels, flipped, more)]
    assert scores[0] == scores[1] == scores[2]


def test_numbers_and_marks_are_no_letters():
    matrix = np.zeros((language.BUCKETS, 1), np.float32)
    assert language.predict(["½", "² Ⅷ ① 12", "", None, "ª", "12 a"], ["en"], matrix)[0] == ["und"] * 4 + ["en"] * 2


def plain_hits(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    own, hit, met = split(text), set(), set()
    for name, item in items:
        words = split(item)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            for at in range(len(own) - size + 1):
                if own[at:at + size] == words[k:k + size]:
                    hit.update(range(at, at + size))
                    met.add(name)
    return len(own), len(hit), len(met)


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_blocks_of_the_benchmark_change_nothing(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", block)
    random = np.random.default_rng(3)
    word = lambda n: " ".join(random.choice(["a", "B", "cc", "é"], n))
    items = [(str(k), word(int(random.integers(1, 16)))) for k in range(12)] + [("3", "a B cc é a B cc"), ("x", None), ("y", "...")]
    texts = [(k, word(int(random.integers(0, 60)))) for k in range(30)] + [(30, None), (31, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id string, text string")).collect()
    want = {d: plain_hits(t, [(n, i) for n, i in items if i is not None]) for d, t in texts}
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in got} == want and any(w[2] > 2 for w in want.values())


def test_stages_take_any_columns_and_rows(spark, sf):
    base = [(1, "Plain text of one kind", "en", "a", 22), (2, None, None, None, None), (3, "", "fr", "a", 0), (None, "no id here", "en", None, 10),
            (5, "same words in this one", "en", "b", 22), (5, "same words in this one", "en", "b", 22), (6, "½ 12", "en", "b", 4),
            (7, "long words " * 60_000, "en", "b", 660_000)] + [(k, f"a text number {k} with words", "en", "a", 27) for k in range(10, 40)]
    docs = spark.createDataFrame(base, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {c: F.lit(f"own {c}") for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf).collect()
        assert rows and stage(spark, docs.limit(0), sf).count() == 0
        if name != "extendible_sharding":
            assert set(rows[0].asDict()) == set(docs.columns) and all(r[c] == f"own {c}" for r in rows for c in CLASHING)
        else:
            assert len(rows) == len(base)
        if name == "language_id":
            assert Counter(r.doc_id for r in rows) == Counter(d for d, t, *_ in base if t and any(map(str.isalpha, t)))
        if name == "simhash_near_dedup":
            assert Counter(r.doc_id for r in rows)[5] == 1 and {None} <= {r.doc_id for r in rows}
        if name == "source_mixing":
            assert max(Counter(r.doc_id for r in rows if r.doc_id != 5).values()) <= 2


def test_stages_against_plain_versions(spark, sf):
    docs = table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, sf).collect()}
    assert kept == {d for d, t in texts.items() if t and any(map(str.isalpha, t))}

    prints = {d: simhash.fingerprint(t) & (1 << 64) - 1 for d, t in texts.items()}
    head = {d: d for d in prints}

    def find(d):
        while head[d] != d:
            d = head[d]
        return d

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS and find(a) != find(b):
                head[max(find(a), find(b))] = min(find(a), find(b))
    stays = {d for d in ids if find(d) == d}
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf).collect()} == stays

    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    cleaned = {r.doc_id: r.text for r in corpus_pipeline.decontamination_stage(spark, docs, sf).collect()}
    marked = {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, table(spark, sf, "benchmark")).collect()}
    for d, text in texts.items():
        if not marked[d]:
            assert cleaned[d] == text
        elif d in cleaned:
            assert len(cleaned[d]) < len(text) and plain_hits(cleaned[d], items)[1] == 0

    shards = corpus_pipeline.sharding_stage(spark, docs, sf).collect()
    assert Counter(r.doc_id for r in shards) == Counter(ids)
    sizes = Counter()
    for r in shards:
        sizes[r.shard] += len(r.text.encode())
    assert all(r.shard_bytes == sizes[r.shard] <= sharding.SHARD_BYTES for r in shards)


def test_the_whole_pipeline(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    docs = {r.doc_id: r for r in table(spark, sf, "documents").collect()}
    times = Counter(r.doc_id for r in rows)
    assert rows and set(times) <= set(docs) and max(times.values()) <= 2
    prints = {simhash.fingerprint(docs[d].text) for d in times}
    assert len(prints) == len(times)
    marked = {r.doc_id: r.n_hit for r in decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).collect()}
    assert all(r.text == docs[r.doc_id].text for r in rows if not marked[r.doc_id])
    assert set(rows[0].asDict()) == {*table(spark, sf, "documents").columns, "shard", "shard_bytes", "shard_rows"}
