"""The stages that turn raw documents into shards of training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aforo.llm.common import stored, table
from aforo.llm.decontaminate import decontaminated
from aforo.llm.language import fit_language, in_known_language
from aforo.llm.mixing import mixed_documents
from aforo.llm.sharding import extendible_shards
from aforo.llm.simhash import near_duplicate_representatives


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, all columns as they are; those without text or any letter go.

    Nothing can be learned from documents without text or lang, and then all go. Repeated rows are judged alike.
    """
    return in_known_language(docs, *fit_language(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Texts without words are copies of each other; of repeated rows one stays, and a missing doc_id stays only in a group without any.
    """
    return near_duplicate_representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out, n_chars follows; a document of nothing else goes. Missing and empty texts pass."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources; a document taken twice is two rows, one without words is taken by none. A missing source is one."""
    return mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with the shard it belongs to; columns that are called like the new ones are replaced."""
    return extendible_shards(docs.drop("shard", "shard_bytes", "shard_rows"))


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("extendible_sharding", sharding_stage),
]

#: Naive Bayes, SimHash and the random draws of the mixture have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again. No documents give no rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
