"""Parquet tables: replace by file, append, drop files, split by year."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.contracts import FILE
from aforo.operators.lookup import lookup, measure
from aforo.session import path_exists, release_shuffles


#: Folder of a table in which the versions of its columns are kept; readers of the table pass it over.
COLUMNS_FOLDER = "_columnas"


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A stored table; without ``schema`` it has all columns recorded for it.

    Files that have no such record are asked for their columns one by one.
    """
    if not path_exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    schema = schema if schema is not None else recorded_columns(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(path)


def _versions(spark: SparkSession, path: str) -> tuple[object, list]:
    """The file system and the record's versions, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COLUMNS_FOLDER}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return fs, sorted((p for p in found if p.getName().endswith(".json")), key=lambda p: p.getName())


def recorded_columns(spark: SparkSession, path: str) -> T.StructType | None:
    """The union of the columns of all files a table ever had, by its latest record."""
    fs, versions = _versions(spark, path)
    if not versions:
        return None
    stream = fs.open(versions[-1])
    try:
        return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def record_columns(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Add a version to the record if ``schema`` brings columns that it lacks.

    A version is a new file that only appears whole, so readers see the old
    columns or the new ones. A column keeps the type it came with.
    """
    known = recorded_columns(spark, path)
    if known is None and path_exists(spark, path) and _partitions(spark, path):
        known = spark.read.option("mergeSchema", "true").parquet(path).schema
    fields = {f.name: f for f in known or []}
    fresh = [T.StructField(f.name, f.dataType) for f in schema if f.name not in fields]
    changed = [f.name for f in schema if f.name in fields and f.dataType != fields[f.name].dataType]
    if changed:
        raise ValueError(f"{path} has {', '.join(changed)} with other types")
    fs, versions = _versions(spark, path)
    if not fresh and versions:
        return
    union = [f for f in [*fields.values(), *fresh] if f.name != FILE]
    text = T.StructType([*union, T.StructField(FILE, T.StringType())]).json()
    target = spark._jvm.org.apache.hadoop.fs.Path
    final = f"{path}/{COLUMNS_FOLDER}/v{len(versions) + 1:08d}.json"
    out = fs.create(target(f"{final}.part"), True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(target(f"{final}.part"), target(final))


def replace_by_file(df: DataFrame, path: str, files: list[str] | None = None) -> None:
    """Put the rows of each file in ``df`` in place of the stored ones.

    A file named in ``files`` that has no rows any more loses its old rows:
    a partition with the same part files as before was not written. New
    columns are recorded first, so that every stored row can be read.
    """
    record_columns(df.sparkSession, path, df.schema)
    before = {f: _parts(df.sparkSession, p) for f, p in _partitions(df.sparkSession, path).items() if f in (files or ())}
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(FILE).parquet(path)
    )
    release_shuffles(df.sparkSession)
    after = _partitions(df.sparkSession, path) if before else {}
    drop_files(df.sparkSession, path, [f for f, names in before.items() if names == _parts(df.sparkSession, after[f])])


def _partitions(spark: SparkSession, path: str) -> dict[str, object]:
    """File name -> folder of a table stored by file (a few hundred)."""
    if not path_exists(spark, path):
        return {}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [status.getPath() for status in fs.listStatus(root)]
    prefix = f"{FILE}="
    return {unquote(f.getName()[len(prefix):]): f for f in folders if f.getName().startswith(prefix)}


def stored_parts(spark: SparkSession, path: str, files: list[str]) -> dict[str, list[str]]:
    """The part files of each of these files that is stored."""
    folders = _partitions(spark, path)
    return {f: sorted(_parts(spark, folders[f])) for f in sorted(files) if f in folders}


def _parts(spark: SparkSession, folder) -> set[str]:
    """Names of the part files; every write gives them a new identifier."""
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in fs.listStatus(folder)}


def stored_files(spark: SparkSession, path: str) -> list[str]:
    return sorted(_partitions(spark, path))


def drop_files(spark: SparkSession, path: str, files: list[str]) -> None:
    """Remove the partitions of whole files from a table stored by file."""
    folders = _partitions(spark, path) if files else {}
    for file in files:
        if file in folders:
            fs = folders[file].getFileSystem(spark._jsc.hadoopConfiguration())
            fs.delete(folders[file], True)


def append(df: DataFrame, path: str, *partition: str) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def purge_completed(staged: DataFrame, state: DataFrame, table: str, phase: str = "HECHOS") -> DataFrame:
    """Staging rows left by a purge: only files whose ``phase`` of this table succeeded go."""
    done = state.where((F.col("tabla_origen") == table) & (F.col("fase") == phase) & (F.col("estado") == "SUCCESS"))
    return staged.join(done.select(FILE).distinct(), FILE, "left_anti")


def write_by_year(df: DataFrame, path: str) -> None:
    """One folder per year. Years are few and uneven, so rows of one year are
    spread over tasks: adaptive execution splits the large ones."""
    df.hint("rebalance", "anio").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("anio").parquet(path)


FILE_PATH, ROW_INDEX = "_path", "_index"


def with_position(stored: DataFrame) -> DataFrame:
    """A parquet scan with each row's file path and index inside that file."""
    return stored.select(
        "*", F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.row_index").alias(ROW_INDEX)
    )


def assign_row_ids(positioned: DataFrame, last_id: int = 0) -> DataFrame:
    """Dense ids after ``last_id`` without moving rows.

    The id is the count of rows in earlier files plus the index in the own
    file, so a task that runs again gives the same ids.
    """
    spark = positioned.sparkSession
    counts = positioned.groupBy(FILE, FILE_PATH).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per archive: a few hundred.
    totals = counts.groupBy(FILE).agg(F.sum("_rows")).orderBy(FILE).collect()
    starts, start = [], last_id
    for name, rows in totals:
        starts.append((name, start))
        start += rows
    archive = spark.createDataFrame(starts, "_archive string, _start long")
    before = (
        "sum(_rows) over (partition by archivo_origen order by _path "
        "rows between unbounded preceding and 1 preceding)"
    )
    offsets = (
        counts.withColumn("_before", F.coalesce(F.expr(before), F.lit(0)))
        .join(F.broadcast(archive), F.col(FILE).eqNullSafe(F.col("_archive")))
        .select(F.col(FILE_PATH).alias("_offset_path"), (F.col("_start") + F.col("_before")).alias("_value"))
    )
    placed = lookup(
        positioned, offsets, {FILE_PATH: "_offset_path"}, "_value", "_offset", small=measure(offsets).small
    )
    columns = [c for c in positioned.columns if c not in (FILE_PATH, ROW_INDEX)]
    return placed.select((F.col("_offset") + F.col(ROW_INDEX) + 1).alias("id"), *columns)
