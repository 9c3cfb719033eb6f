"""Small helpers the operators share: letter case, word patterns, stored tables, bounds."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.session import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words between white space, as a Java expression.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII takes the quick built-in, with the same outcome."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows written once below the shared folder and read back.

    A lost executor costs nothing that was stored, and random or
    position-dependent values cannot change between two uses.
    """
    spark = frame.sparkSession
    path = work_dir(spark, label)
    frame.write.parquet(path)
    again = spark.read.schema(frame.schema).parquet(path)
    again.stored_at = path
    return again


def discard(*frames: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more; a table of another origin stays."""
    for frame in frames:
        path = getattr(frame, "stored_at", None)
        if path:
            spark = frame.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def give_back() -> None:
    """Hand freed memory back to the system: an idle Python worker keeps its pages beside the next stage's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        start, held = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for at, length in enumerate(lengths):
            if held and held + length > most:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += length
        if batch.num_rows > start:
            yield batch.slice(start)
    give_back()


def learning_part(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def bounded_part(frame: DataFrame, doc_id: str, most: int, salt: str = "sample") -> DataFrame:
    """A sample of about ``most`` rows, spread evenly by a hash of the id.

    All rows when there are no more than that. The same rows every time, and
    nothing is sorted or gathered to choose them. A sample of a sample takes
    another ``salt``: by the same hash its rows are all small already.
    """
    total = frame.count()
    if total <= most:
        return frame
    share = int(most / total * (1 << 30))
    return frame.where(F.pmod(F.xxhash64(F.lit(salt), doc_id), F.lit(1 << 30)) < share)
