"""Token totals by source, language and tokenizer version, maintained by signed batches."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm.common import documents, in_bytes
from aforo.llm.mixing import words_in
from aforo.session import path_exists, work_dir

TOKENIZERS = "/opt/tokenizers"
VERSION = "byte_bpe_50k"
#: Largest vocabulary file that is broadcast.
VOCABULARY_BYTES = 64 << 20
#: How the vocabulary's tokenizer cuts a text before merging (a fixed value of that tokenizer).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GROUP = ["source", "lang", "tokenizer"]
#: Batches read one by one before they are folded together.
FOLD_AFTER = 64


def encoding(vocabulary: bytes):
    import tiktoken  # only this function needs it

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_counts(docs: DataFrame, folder: str = TOKENIZERS, version: str = VERSION) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens) of whole texts; a missing text has no token."""
    with open(f"{folder}/{version}.tiktoken", "rb") as file:
        vocabulary = file.read(VOCABULARY_BYTES + 1)
    if len(vocabulary) > VOCABULARY_BYTES:
        raise ValueError(f"{version} is larger than {VOCABULARY_BYTES} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(shared.value).encode_ordinary
        for batch in in_bytes(batches, "text"):
            sizes = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "source", "lang")), pa.array(sizes, pa.int64())], names=["doc_id", "source", "lang", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "source", "lang", "text").mapInArrow(
        count, f"doc_id {kind}, source string, lang string, n_tokens long").withColumn("tokenizer", F.lit(version))


def word_counts(docs: DataFrame) -> DataFrame:
    """The same by white space, as version ``words``."""
    return docs.select("doc_id", "source", "lang", words_in(F.col("text")).alias("n_tokens"), F.lit("words").alias("tokenizer"))


def signed(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Counted documents as changes: +1 for those that come, -1 for those that go.

    A revised count is both: the row as it was in ``deleted``, the new one in ``inserted``.
    """
    parts = [f.select(*GROUP, "n_tokens", F.lit(s).alias("sign")) for f, s in ((inserted, 1), (deleted, -1)) if f is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class TokenTotals:
    """Totals in a folder: one small table of sums for each committed batch, folded now and then.

    A batch is committed when its folder is complete, which Spark marks by a
    file written last. Committing an id again does nothing, so a job that died
    at any point is simply run again. Sums are additive: batches may come in
    any order.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _complete(self, prefix: str) -> dict[str, str]:
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path_exists(self.spark, self.folder):
            return {}
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        paths = [s.getPath() for s in fs.listStatus(top)]
        return {p.getName()[len(prefix):]: p.toString() for p in paths
                if p.getName().startswith(prefix) and path_exists(self.spark, f"{p.toString()}/_SUCCESS")}

    def _base(self) -> tuple[int, DataFrame | None, set[str]]:
        """The newest complete folding: its number, sums and the batches in it."""
        done = self._complete("folded-")
        if not done:
            return 0, None, set()
        newest = max(done, key=int)
        rows = self.spark.read.parquet(done[newest])
        ids = {r.batch for r in rows.where("batch IS NOT NULL").select("batch").toLocalIterator()}
        return int(newest), rows.where("batch IS NULL").drop("batch"), ids

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add the signed changes (source, lang, tokenizer, n_tokens, sign); False if the batch was there already."""
        open_ids = self._complete("batch-")
        folded = self._base()[2]
        if batch in open_ids or batch in folded:
            return False
        sums = changes.groupBy(*GROUP).agg(
            F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/batch-{batch}")
        if len(open_ids.keys() - folded) >= FOLD_AFTER:
            self.fold()
        return True

    def _rows(self) -> tuple[int, DataFrame | None, set[str]]:
        number, base, folded = self._base()
        fresh = {b: p for b, p in self._complete("batch-").items() if b not in folded}
        parts = ([base] if base is not None else []) + ([self.spark.read.parquet(*fresh.values())] if fresh else [])
        rows = None
        for part in parts:
            part = part.select(*GROUP, "documents", "tokens")
            rows = part if rows is None else rows.unionByName(part)
        return number, rows, folded | set(fresh)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens; groups whose documents are all gone are left out."""
        _, rows, _ = self._rows()
        if rows is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, documents long, tokens long")
        return rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where(
            "documents != 0 OR tokens != 0")

    def fold(self) -> None:
        """Write all batches as one table of sums with their ids. Until it is complete the old ones are read."""
        number, rows, ids = self._rows()
        if rows is None:
            return
        sums = rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        names = self.spark.createDataFrame([(i,) for i in sorted(ids)], "batch string")
        sums.unionByName(names, allowMissingColumns=True).write.mode("overwrite").parquet(f"{self.folder}/folded-{number + 1}")


def token_totals(docs: DataFrame, folder: str | None = None, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Totals of ``docs`` by two tokenizer versions, each an insert of its own batch, the second one delivered twice.

    A missing source or language is a group of its own; a missing or empty text
    counts as a document of no tokens; repeated rows count each; no rows give no rows.
    """
    spark = docs.sparkSession
    totals = TokenTotals(spark, folder or work_dir(spark, "token-totals"))
    totals.commit("load-words", signed(word_counts(docs)))
    for _ in range(2):
        totals.commit(f"load-{VERSION}", signed(bpe_counts(docs, tokenizers)))
    return totals.totals()


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_totals(documents(spark, sf_dir))
