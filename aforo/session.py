"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Staged file names are text even when they look like numbers or dates.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # The facts have more than a hundred columns. Their generated methods are
    # beyond the size up to which the JVM compiles by default.
    "spark.sql.codegen.maxFields": "300",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(app: str = "aforo", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session. Only a local master may
    go without it: there one machine runs everything, so a fresh temporary
    folder is reachable by all tasks.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="aforo-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def release_shuffles(spark: SparkSession) -> None:
    """Let go of shuffle files no plan needs any more.

    Spark deletes them when the driver drops the last plan that knows them,
    which a large heap puts off: have it do so between the large steps of a job.
    Python's handles of plans are in cycles, so they are collected first. What Spark
    tidies up after one collection may hold the last plan until the next, now and
    then until a later call.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.3)
    spark._jvm.System.gc()


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it; nothing happens if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
