"""SimHash, decontamination, passages and token totals against brute force on small tables."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from aforo.llm import common, decontaminate, paragraphs, quality, simhash, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_components(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    parent = {d: d for d in prints}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    for r in simhash.near_duplicates(docs).collect():
        assert int(r.fingerprint, 16) == prints[r.doc_id] and r.component_id == top(r.doc_id)


def test_masks_cover_every_pair_of_bits():
    masks = simhash.covering_masks()
    assert all(any(not m >> i & 1 and not m >> j & 1 for m in masks) for i in range(64) for j in range(64))


def test_contamination_equals_sql(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    got = decontaminate.contamination(docs, items).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(decontaminate.SQL).fetchall())


def test_cut_takes_the_passage_only(spark):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = spark.createDataFrame([(1, f"before it. {item} and after", "en", "a", 0), (2, item, "en", "a", 0), (3, None, None, None, None),
                                  (4, "clean text", "en", "a", 10)], DOCS)
    items = spark.createDataFrame([(7, item), (8, None), (None, "")], "item_id long, text string")
    out = {r.doc_id: r.text for r in decontaminate.decontaminated(docs, items).collect()}
    assert out == {1: "before it. \n and after", 3: None, 4: "clean text"}


def test_passages(spark):
    body = " ".join(f"w{k}" for k in range(60))
    near = body.replace("w30", "other")
    rows = [(1, f"head\n{body}\ntail", "en", "a", 0), (2, f"x\n{near}", "en", "a", 0), (3, "short line", "en", "a", 0),
            (4, "own words " + " ".join(f"v{k}" for k in range(50)) + f" {body} end", "en", "a", 0), (5, None, None, None, None)]
    got = paragraphs.passages(spark.createDataFrame(rows, DOCS)).collect()
    removed = {r.doc_id for r in got if r.removed}
    assert removed == {2, 4} and {r.doc_id for r in got} == {1, 2, 4}


@pytest.mark.parametrize("a, b, d", [([], [b"x"], 1), ([b"a", b"b"], [b"a", b"c"], 1), ([b"a"] * 9, [b"a"] * 4, 5)])
def test_edits(a, b, d):
    assert paragraphs.edits(a, b) == d == paragraphs.edits(b, a)


def test_token_totals_by_batches(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two", "en", "a", 0), (2, "three", None, "a", 0), (3, None, "en", None, 0)], DOCS)
    counted = tokens.bpe_counts(docs)
    with open(f"{tokens.TOKENIZERS}/{tokens.VERSION}.tiktoken", "rb") as file:
        encode = tokens.encoding(file.read()).encode_ordinary
    totals = tokens.TokenTotals(spark, str(tmp_path / "t"))
    assert totals.commit("1", tokens.signed(counted)) and not totals.commit("1", tokens.signed(counted))
    assert totals.commit("2", tokens.signed(deleted=counted.where("doc_id = 1")))
    totals.fold()
    assert not totals.commit("2", tokens.signed(counted))
    assert totals.commit("3", tokens.signed(counted.where("doc_id = 1").selectExpr("doc_id", "source", "lang", "n_tokens + 5 AS n_tokens", "tokenizer")))
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in totals.totals().collect()}
    assert got == {("a", "en"): (1, len(encode("one two")) + 5), ("a", None): (1, len(encode("three"))), (None, "en"): (1, 0)}


def test_a_sample_of_a_sample_is_bounded(spark):
    first = common.bounded_part(spark.range(100_000).withColumnRenamed("id", "doc_id"), "doc_id", 10_000)
    second = common.bounded_part(first, "doc_id", 1_000, "fit")
    assert 9_000 < first.count() < 11_000 and 800 < second.count() < 1_200


def test_unlike_texts_around_one_passage_are_all_compared(spark):
    """One bucket of many unlike texts; what is similar in it is found however late its texts lead."""
    random = np.random.default_rng(3)
    common_words = [f"c{k}" for k in range(20)]
    bodies = []
    for k in range(70):
        own = [f"u{k}_{j}" for j in range(int(random.integers(14, 30)))]
        bodies.append(common_words + own)
        if k % 7 == 0:
            bodies += [common_words + [*own[:j], "edit", *own[j + 1:]] for j in (2, 9)]
    names = {hashlib.md5(b" ".join(w.encode() for w in b)).digest(): b" ".join(w.encode() for w in b) for b in bodies}
    frame = spark.createDataFrame([(bytearray(h), bytearray(b)) for h, b in names.items()], "h binary, body binary")
    members = frame.select(F.lit(0).alias("band"), F.lit(1).cast("long").alias("key"), "h")
    got = {frozenset((bytes(r.a), bytes(r.b))) for r in paragraphs.similar_links(frame, members).collect()}
    want = {frozenset((a, b)) for a in names for b in names if a < b and paragraphs.similar(names[a], names[b])}
    assert len(want) >= 20 and got <= want

    def groups(pairs):
        parent = {h: h for h in names}

        def top(h):
            while parent[h] != h:
                h = parent[h]
            return h

        for x, y in map(sorted, pairs):
            parent[top(y)] = top(x)
        return {frozenset(h for h in names if top(h) == root) for root in map(top, names)}

    assert groups(got) == groups(want)
    empty = paragraphs.similar_links(frame, members.limit(0))
    assert empty is None


@pytest.mark.parametrize("run", [
    lambda d, labels: quality.quality(d, labels), lambda d, labels: toxicity.toxicity(d, labels),
    lambda d, labels: simhash.near_duplicates(d)])
def test_odd_rows_of_scores_and_fingerprints(spark, run):
    """Missing values, empty and very long texts, repeated rows, clashing columns, no rows, no labels."""
    rows = [(1, "plain words here", "en", "a", 0), (1, "plain words here", "en", "a", 0), (2, "", "en", None, 0),
            (3, None, None, None, None), (None, "no id", None, None, None), (4, "long " * 100_000, "en", "a", 0), (5, "12 !!", "en", "b", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("score", "label", "h", "predicted", "component_id", "fingerprint")})
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, 0, 1), (4, 1, 1), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (marks, marks.limit(0)):
        got = run(docs, labels).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
        assert all("score" not in r or 0 <= r.score <= 1 for r in got)
        assert run(docs.limit(0), labels).count() == 0


def test_a_fold_waits_for_unfolded_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "FOLD_AFTER", 2)
    totals, folds = tokens.TokenTotals(spark, str(tmp_path / "t")), []
    one = spark.createDataFrame([("a", "en", "words", 5, 1)], "source string, lang string, tokenizer string, n_tokens long, sign int")
    for k in range(6):
        assert totals.commit(str(k), one)
        folds.append(len(totals._complete("folded-")))
    # Two batches are open before the third commit, which folds all three; the next fold comes three commits later.
    assert folds == [0, 0, 1, 1, 1, 2]
    assert not totals.commit("0", one)
    assert [(r.documents, r.tokens) for r in totals.totals().collect()] == [(6, 30)]
