import numpy as np
from pyspark.sql import functions as F

from aforo.llm import toxicity
from aforo.llm.quality import held_out


def test_all_labelled_rows_teach(spark, monkeypatch):
    """Also where there are many more of them than one part or its calibration has."""
    monkeypatch.setattr(toxicity, "TRAINING_ROWS", 30)
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 20)
    # Parts of so few rows make few steps in a pass.
    monkeypatch.setattr(toxicity, "PASSES", 12)
    seen = {}
    monkeypatch.setattr(toxicity, "trained", lambda rows, n, share, run=toxicity.trained: (seen.update(train=rows.count(), n=n), run(rows, n, share))[1])
    monkeypatch.setattr(toxicity, "judged", lambda rows, *a, run=toxicity.judged: (seen.update(check=rows.count()), run(rows, *a))[1])
    random = np.random.default_rng(1)
    plain = [f"{a}{b}" for a in "bcdfgh" for b in ("alo", "eru", "ino")]
    docs = [(k, " ".join(random.choice(plain, 12)) + (" schurkx" if k % 4 == 0 else ""), "xx") for k in range(400)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    learnt = docs.where(~held_out(F.col("doc_id"))).count()
    rows = toxicity.toxicity(docs, labels).collect()
    assert learnt > 200 and seen["n"] == seen["train"] and seen["train"] + seen["check"] == learnt
    assert [r.doc_id for r in rows if r.predicted != (r.doc_id % 4 == 0)] == []


def test_every_row_is_passed_as_often_with_many_parts_as_with_one(spark, monkeypatch):
    def counting(net, texts, labels, share, epochs):
        net.level += epochs
        return net

    monkeypatch.setattr(toxicity, "train", counting)
    rows = spark.createDataFrame([(k, "a b", k % 2) for k in range(60)], "doc_id long, text string, label int")
    for most in (100, 20):
        monkeypatch.setattr(toxicity, "TRAINING_ROWS", most)
        assert toxicity.trained(rows, 60, 0.5).level[0] == toxicity.EPOCHS


def test_gradients_of_a_batch_are_the_sums_of_its_documents():
    """Also where documents are empty or shorter than a window, and words come twice."""
    texts = ["aa bb cc aa dd", "", "ee", "bb bb ff", "aa gg"]
    labels, weights = np.array([1.0, 0, 1, 0, 0]), np.array([1.0, 2, 1, 2, 0.5])
    vocabulary = toxicity.Vocabulary()
    docs = [vocabulary.read(t) for t in texts]
    rows, net = vocabulary.rows(), toxicity.Network()
    at, total, rest = toxicity.gradients(net, docs, rows, labels, weights)
    expected = [np.zeros_like(p) for p in net.parameters()]
    for own, label, weight in zip(docs, labels, weights):
        best, where = net.pooled(net.tables(rows), own)
        active = np.maximum(best + net.bias, 0)
        error = (1 / (1 + np.exp(-net.logits(best[None])[0])) - label) * weight / len(docs)
        back = error * net.out.reshape(active.shape) * (active > 0)
        expected[-1] += error
        expected[-2] += error * active.ravel()
        expected[-3] += back
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS if len(own) >= width else 0):
                for j in range(width):
                    places = rows[own[where[k, f] + j]]
                    expected[1 + k][j, :, f] += back[k, f] * net.embedding[places].sum(axis=0)
                    np.add.at(expected[0], places, back[k, f] * net.filters[k][j, :, f])
    whole = np.zeros_like(net.embedding)
    whole[at] = total
    assert len(at)
    for mine, theirs in zip([whole, *rest], expected):
        np.testing.assert_allclose(mine, theirs, rtol=1e-4, atol=1e-6)
