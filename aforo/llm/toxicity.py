"""Toxicity of a text by a convolutional classifier over hashed word embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm import language
from aforo.llm.common import discard, documents, in_bytes, stored, table
from aforo.llm.quality import held_out, marks_to_learn

#: Rows of the embedding table. A word is the sum of the rows of the word and of its beginnings (in bytes).
ROWS = 1 << 15
SIZE = 16
BEGINNINGS = (4, 5)
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Of so many labelled documents together, about, these train and those calibrate. All of them do either.
#: About TRAINING_ROWS documents are also one part, which one task trains on.
TRAINING_ROWS = 4_000
CALIBRATION_ROWS = 3_000
#: Passes over the training rows; with more parts, passes of each between two averagings, and how many of these. They are as many in all.
EPOCHS = 12
PASSES, ROUNDS = 4, 3
BATCH = 32
RATE = 0.01
SEED = 9
#: A language with fewer calibration documents of either label takes the common threshold.
LEAST = 5
#: Words are runs of a-z and everything beyond ASCII, after lower-casing; all other bytes part them.
_PART = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Weights are averaged as whole multiples of 1 / FIXED, so that the order of the parts does not count, CHUNK at a time.
FIXED = 1 << 24
CHUNK = 8192
#: Bits of the filter that texts without a label do not pass; its size does not grow with the input.
FILTER_BITS = 1 << 24
#: Steps of the log-odds by which calibration counts documents, and where they end.
STEPS, MOST = 100, 30
#: What a window that leaves its document adds to a filter.
OUTSIDE = np.float32(-1e6)


class Vocabulary:
    """Numbers for the words met and the embedding rows of each."""

    def __init__(self):
        self.number: dict[bytes, int] = {}

    def read(self, text: str | None) -> np.ndarray:
        own, number = (text or "").lower().encode("utf-8", "replace").translate(_PART).split(), self.number
        for w in sorted(set(own).difference(number)):
            number[w] = len(number)
        return np.fromiter(map(number.__getitem__, own), np.int64, len(own))

    def rows(self) -> np.ndarray:
        n = len(self.number)
        hashes = [np.fromiter(map(crc32, self.number), np.int64, n)]
        hashes += [np.fromiter((crc32(w[:k], k) for w in self.number), np.int64, n) for k in BEGINNINGS]
        return np.stack(hashes, axis=1) % ROWS


class Network:
    """Embeddings, one bank of filters per width with max pooling, a logistic output."""

    def __init__(self):
        r = np.random.default_rng(SEED)
        self.embedding = (0.1 * r.standard_normal((ROWS, SIZE))).astype(np.float32)
        self.filters = [(0.3 * r.standard_normal((w, SIZE, FILTERS))).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = (0.3 * r.standard_normal(len(WIDTHS) * FILTERS)).astype(np.float32)
        self.level = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.out, self.level]

    def tables(self, rows: np.ndarray) -> list[list[np.ndarray]]:
        """What each word adds to the filters of each width at each place of the window."""
        words = self.embedding[rows].sum(axis=1)
        return [[words @ f[k] for k in range(len(f))] for f in self.filters]

    def pooled(self, tables, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strongest response of every filter in one document, and where."""
        best, where = np.zeros((len(WIDTHS), FILTERS), np.float32), np.zeros((len(WIDTHS), FILTERS), np.int64)
        for k, width in enumerate(WIDTHS):
            if len(own) >= width:
                n = len(own) - width + 1
                response = sum(tables[k][j][own[j:j + n]] for j in range(width))
                where[k] = response.argmax(axis=0)
                best[k] = response[where[k], np.arange(FILTERS)]
        return best, where

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0).reshape(len(pooled), -1) @ self.out + self.level


def train(net: Network, texts: list[str | None], labels: np.ndarray, share: float, epochs: int) -> Network:
    """Adam on the cross-entropy from where ``net`` is, both labels weighing the same; ``share`` of all training rows have label 1.

    Gradients flow through the pooled windows only.
    """
    vocabulary = Vocabulary()
    docs = [vocabulary.read(t) for t in texts]
    rows = vocabulary.rows()
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    spare = [(np.empty_like(p), np.empty_like(p)) for p in params]
    random, step = np.random.default_rng(SEED), 0
    for _ in range(epochs):
        order = random.permutation(len(docs))
        for begin in range(0, len(order), BATCH):
            batch = order[begin:begin + BATCH]
            at, total, rest = gradients(net, [docs[d] for d in batch], rows, labels[batch], weights[batch])
            step += 1
            for i, (x, m, v, (a, b)) in enumerate(zip(params, first, second, spare)):
                # Rows of the embedding that no window of the batch holds have no gradient; their averages decay.
                own, g = (at, total) if i == 0 else (slice(None), rest[i - 1])
                m *= 0.9
                m[own] += 0.1 * g
                v *= 0.999
                v[own] += 0.001 * (g * g)
                np.sqrt(v, out=a)
                a *= (1 - 0.999 ** step) ** -0.5
                a += 1e-8
                np.divide(m, a, out=b)
                b *= RATE / (1 - 0.9 ** step)
                x -= b
    return net


def gradients(net: Network, docs: list[np.ndarray], rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple:
    """Of one batch: the embedding rows that have a gradient, theirs, and those of the other parameters in order.

    The documents are laid end to end, as where they are scored.
    """
    gap = np.full(max(WIDTHS), len(rows), np.int64)
    used, line = np.unique(np.concatenate([part for own in docs for part in (own, gap)]), return_inverse=True)
    starts = np.cumsum([0] + [len(own) + len(gap) for own in docs[:-1]])
    lengths = np.array([len(own) for own in docs])
    # The gap has the highest number, so it is the last of those used.
    places = rows[used[:-1]]
    words = net.embedding[places].sum(axis=1)
    pooled, where = np.zeros((len(docs), len(WIDTHS), FILTERS), np.float32), []
    for k, width in enumerate(WIDTHS):
        long = np.flatnonzero(lengths >= width)
        tables = [np.concatenate([words @ f, np.full((1, FILTERS), OUTSIDE, np.float32)]) for f in net.filters[k]]
        response = tables[0][line]
        for j in range(1, width):
            response[:-j] += tables[j][line[j:]]
        spots = np.zeros((len(long), FILTERS), np.int64)
        for i, d in enumerate(long):
            own = response[starts[d]:starts[d] + lengths[d] - width + 1]
            spots[i] = own.argmax(axis=0)
            pooled[d, k] = own[spots[i], np.arange(FILTERS)]
        where.append((long, spots + starts[long][:, None]))
    active = np.maximum(pooled + net.bias, 0)
    p = 1 / (1 + np.exp(-np.clip(net.logits(pooled), -30, 30)))
    error = ((p - labels) * weights / len(docs)).astype(np.float32)
    back = error[:, None, None] * net.out.reshape(len(WIDTHS), FILTERS) * (active > 0)
    filters, met, sent = [np.zeros_like(f) for f in net.filters], [], []
    for k, (long, spots) in enumerate(where):
        own = back[long, k]
        for j in range(WIDTHS[k]):
            word = line[spots + j]
            filters[k][j] = np.einsum("dfs,df->sf", words[word], own)
            met.append(word.ravel())
            sent.append((own[:, :, None] * net.filters[k][j].T).reshape(-1, SIZE))
    met = places[np.concatenate(met)].ravel()
    sent = np.repeat(np.concatenate(sent), 1 + len(BEGINNINGS), axis=0)
    at, total = np.zeros(0, np.int64), np.zeros((0, SIZE), np.float32)
    if len(met):
        order = np.argsort(met, kind="stable")
        at, begins = np.unique(met[order], return_index=True)
        total = np.add.reduceat(sent[order], begins, axis=0)
    return at, total, [*filters, back.sum(axis=0), error @ active.reshape(len(docs), -1), error.sum(keepdims=True)]


def probabilities(net: Network, texts: list[str | None]) -> np.ndarray:
    """Of whole texts, before calibration. The texts are laid end to end, parted by words that no window may hold."""
    vocabulary = Vocabulary()
    docs = [vocabulary.read(t) for t in texts]
    pooled = np.zeros((len(docs), len(WIDTHS), FILTERS), np.float32)
    if docs:
        gap = np.full(max(WIDTHS), len(vocabulary.number), np.int64)
        line = np.concatenate([part for own in docs for part in (own, gap)])
        starts = np.cumsum([0] + [len(own) + len(gap) for own in docs[:-1]])
        lengths = np.array([len(own) for own in docs])
        for k, tables in enumerate(net.tables(vocabulary.rows())):
            tables = [np.concatenate([t, np.full((1, FILTERS), OUTSIDE, np.float32)]) for t in tables]
            response = np.take(tables[0], line, axis=0)
            for j in range(1, len(tables)):
                response[:-j] += np.take(tables[j], line[j:], axis=0)
            best = np.maximum.reduceat(response, starts, axis=0)
            pooled[lengths >= WIDTHS[k], k] = best[lengths >= WIDTHS[k]]
    return 1 / (1 + np.exp(-np.clip(net.logits(pooled).astype(np.float64), -30, 30)))


def best_threshold(steps: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> float:
    """Between two neighbouring probabilities, where the F1 measure of label 1 is best; of equals the widest gap.

    ``ones`` and ``zeros`` count the documents of either label at each step of the log-odds.
    """
    order = np.argsort(-steps)
    s, hits = 1 / (1 + np.exp(-steps[order] / STEPS)), np.cumsum(ones[order])
    f1 = 2 * hits / (np.cumsum((ones + zeros)[order]) + ones.sum())
    below = np.append(s[1:], 0.0)
    top = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = top[np.argmax((s - below)[top])]
    return float(np.clip((s[k] + below[k]) / 2, 1e-6, 1 - 1e-6))


class Classifier:
    """The network, a language model, and the threshold of each language it can find."""

    def __init__(self, net: Network, languages: tuple, thresholds: dict[str, float], common: float):
        self.net, self.languages, self.thresholds, self.common = net, languages, thresholds, common

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities bent so that the threshold of the text's language lies at 0.5."""
        p = probabilities(self.net, texts)
        langs, _ = language.predict(texts, *self.languages)
        t = np.array([self.thresholds.get(x, self.common) for x in langs])
        return np.where(p < t, 0.5 * p / t, 0.5 + 0.5 * (p - t) / (1 - t))


def trained(rows: DataFrame, n: int, share: float) -> Network:
    """A network trained on all rows (doc_id, text, label).

    A part of them is trained on by one task; between rounds the networks of
    the parts are averaged by their rows. The driver gets the average alone.
    """
    parts = max(1, round(n / TRAINING_ROWS))
    rounds, epochs = (1, EPOCHS) if parts == 1 else (ROUNDS, PASSES)
    dealt = (
        rows.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(parts)).cast("int"))
        .repartition(3 * parts, "part").sortWithinPartitions("part", "doc_id", "label", "text")
    )
    net, context = Network(), rows.sparkSession.sparkContext
    for _ in range(rounds):
        start = context.broadcast(net.parameters())

        def fitted(texts: list, labels: list) -> pa.RecordBatch:
            own = Network()
            for mine, given in zip(own.parameters(), start.value):
                mine[...] = given
            train(own, texts, np.array(labels, np.float64), share, epochs)
            line = np.rint(np.concatenate([p.ravel() for p in own.parameters()]).astype(np.float64) * FIXED).astype(np.int64) * len(texts)
            pieces = [line[k:k + CHUNK].tobytes() for k in range(0, len(line), CHUNK)]
            return pa.RecordBatch.from_arrays(
                [pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], names=["chunk", "total"])

        def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, texts, labels = None, [], []
            for batch in in_bytes(batches, "text", 4 << 20):
                for p, text, label in zip(*(batch.column(c).to_pylist() for c in ("part", "text", "label"))):
                    if p != part and texts:
                        yield fitted(texts, labels)
                        texts, labels = [], []
                    part = p
                    texts.append(text)
                    labels.append(label)
            if texts:
                yield fitted(texts, labels)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, total in zip(batch.column("chunk").to_pylist(), batch.column("total").to_pylist()):
                    sums[k] = sums.get(k, 0) + np.frombuffer(total, np.int64)
            for k, total in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "total"])

        schema = "chunk int, total binary"
        sums = dealt.select("part", "text", "label").mapInArrow(by_part, schema).repartition("chunk").mapInArrow(added, schema).collect()
        line = np.concatenate([np.frombuffer(r.total, np.int64) for r in sorted(sums, key=lambda r: r.chunk)]) / (FIXED * n)
        net, at = Network(), 0
        for p in net.parameters():
            p[...] = line[at:at + p.size].reshape(p.shape)
            at += p.size
        start.unpersist()
    return net


def judged(rows: DataFrame, net: Network, languages: tuple) -> list:
    """How many documents of each predicted language and label have which log-odds; at most some thousands of steps a language."""
    model = rows.sparkSession.sparkContext.broadcast((net, languages))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            p = probabilities(model.value[0], texts)
            at = np.rint(STEPS * np.clip(np.log(p / (1 - p)), -MOST, MOST)).astype(np.int32)
            langs, _ = language.predict(texts, *model.value[1])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(at), batch.column("label")], names=["lang", "step", "label"])

    found = rows.select("text", "label").mapInArrow(steps, "lang string, step int, label int")
    return found.groupBy("lang", "step").agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros")).orderBy("lang", "step").collect()


def marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, text, label) of all marked documents. Texts of others do not move, but for the few that a filter of fixed size lets through."""
    at = F.pmod(F.xxhash64(F.lit("mark"), F.col("doc_id").cast("string")), F.lit(FILTER_BITS))
    places = marks.select(at.alias("at")).groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[places.column("word").to_numpy()] = places.column("bits").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text", 4 << 20):
            own = batch.column("at").to_numpy()
            yield batch.select(["doc_id", "text"]).filter(pa.array((sent.value[own >> 6] >> (own & 63) & 1).astype(bool)))

    few = docs.select("doc_id", "text", at.alias("at")).mapInArrow(kept, docs.select("doc_id", "text").schema)
    # Ids grow with the input, so they are not broadcast however few they are now.
    return few.join(marks.hint("merge"), "doc_id").select("doc_id", "text", "label")


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    """Train and calibrate on all labelled rows that are not held out, by tasks; the driver gets weights and counts."""
    own = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text")
    use = F.pmod(F.xxhash64(F.lit("use"), "doc_id"), F.lit(1000))
    rows = stored(marked(own, marks_to_learn(labels, "toxic")).select(
        "doc_id", "text", "label", (use < 1000 * TRAINING_ROWS // (TRAINING_ROWS + CALIBRATION_ROWS)).alias("training")), "toxicity")
    n = {(r.training, r.label): r["count"] for r in rows.groupBy("training", "label").count().collect()}
    if not n:
        discard(rows)
        return None
    both = {flag: len({y for f, y in n if f == flag}) == 2 for flag in (True, False)}
    learn = rows.where("training") if both[True] else rows
    check = rows.where(F.col("training") != both[False]) if both[True] else rows
    counts = {y: n.get((True, y), 0) + (0 if both[True] else n.get((False, y), 0)) for y in {y for _, y in n}}
    total = sum(counts.values())
    net = trained(learn, total, min(max(counts.get(1, 0) / total, 1e-3), 1 - 1e-3))
    spoken = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    languages = language.train(spoken.select("text", "lang"))
    found = judged(check, net, languages)
    discard(rows)
    lang, step, ones, zeros = (np.array([r[c] for r in found]) for c in ("lang", "step", "ones", "zeros"))
    if not (ones.sum() and zeros.sum()):
        return Classifier(net, languages, {}, 0.5)
    enough = [x for x in sorted(set(lang)) if min(ones[lang == x].sum(), zeros[lang == x].sum()) >= LEAST]
    steps, place = np.unique(step, return_inverse=True)
    common = best_threshold(steps, np.bincount(place, ones), np.bincount(place, zeros))
    return Classifier(net, languages, {x: best_threshold(*(c[lang == x] for c in (step, ones, zeros))) for x in enough}, common)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    The whole text counts. Its language, needed for the threshold, is predicted
    from the text. A missing text or one without words is scored by the bias
    terms alone. Missing labels teach nothing, several of one document count by
    their mean; without any label all scores are 0. Repeated rows give repeated
    rows, no rows give none, other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            found = model.value.score(texts) if model.value else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
