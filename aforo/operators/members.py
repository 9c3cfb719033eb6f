"""Dimension members: union of roles, distinct keys, insert-ignore, ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aforo.contracts import FILE
from aforo.functions.text import sql_clean
from aforo.session import shared_dir

MEMBER_KEY = ["dim", "codigo", "subcodigo", "cod_dim_pais"]
ATTRIBUTES = ["nombre", "direccion", "telefono"]


def not_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose columns all hold more than spaces."""
    return df.filter(reduce(lambda a, b: a & b, [sql_clean(c).isNotNull() for c in columns]))


def distinct_values(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[c.alias(name) for name, c in columns.items()]).distinct()


def union_roles(df: DataFrame, roles: list[Column], keep: list[str]) -> DataFrame:
    """One output row per input row and role, from a single scan.

    Every role is a struct of the same fields; rows without ``codigo`` are left out.
    """
    names = [f"_role{i}" for i in range(len(roles))]
    wide = df.select(*keep, *[role.alias(name) for role, name in zip(roles, names)])
    long = wide if len(names) == 1 else wide.unpivot(keep, names, "_role", "_role0")
    fields = wide.schema[names[0]].dataType.names
    return long.filter(F.col("_role0.codigo").isNotNull()).select(
        *keep, *[F.col(f"_role0.{f}").alias(f) for f in fields]
    )


def _hash_distinct(df: DataFrame) -> DataFrame:
    """Distinct rows, as a step the optimizer keeps.

    A plain ``distinct`` below a minimum is dropped as redundant, and the
    minimum of texts would then sort every input row. The test on the count
    keeps this hash aggregation, which shrinks the data before the shuffle.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_times"))
    return counted.filter(F.col("_times") > 0).drop("_times")


def min_attrs_by_key(df: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Smallest non-NULL value of each attribute, each on its own."""
    return (
        _hash_distinct(df.select(*keys, *attributes))
        .groupBy(*keys).agg(*[F.min(a).alias(a) for a in attributes])
    )


def first_file_attrs_by_key(df: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """The attributes the first file of each key would have stored.

    Within a file the minimum counts; across files the first file wins, even
    when its value is NULL. Equal to loading the files one by one in name order.
    """
    first = [
        F.min(F.struct(F.col(FILE), F.col(a).isNull(), F.col(a).alias("value")))["value"].alias(a)
        for a in attributes
    ]
    return (
        _hash_distinct(df.select(*keys, FILE, *attributes))
        .groupBy(*keys).agg(F.min(FILE).alias("desde_archivo"), *first)
    )


def insert_ignore(
    candidates: DataFrame, existing: DataFrame, key: list[str] = MEMBER_KEY, collation: str | None = None
) -> DataFrame:
    """Candidates whose natural key is not stored yet.

    With ``collation`` (for example ``UNICODE_CI_AI``) keys that differ only in
    case or accents count as the same.
    """
    def same(c: str) -> Column:
        left, right = candidates[c], stored[c]
        if collation and c in ("codigo", "subcodigo"):
            left, right = F.collate(left, collation), F.collate(right, collation)
        return left.eqNullSafe(right)

    stored = existing.select(*key)
    return candidates.join(stored, reduce(lambda a, b: a & b, [same(c) for c in key]), "left_anti")


def one_spelling(candidates: DataFrame, collation: str) -> DataFrame:
    """One member per key under a collation: the smallest spelling."""
    others = [c for c in candidates.columns if c not in ("codigo", "subcodigo")]
    grouped = [c for c in ("dim", "cod_dim_pais") if c in others]
    return (
        candidates
        .groupBy(*grouped, F.collate("codigo", collation).alias("_k"), F.collate("subcodigo", collation).alias("_s"))
        .agg(F.min(F.struct("codigo", "subcodigo", *others)).alias("row"))
        .select("row.*").select(*candidates.columns)
    )


def assign_member_ids(
    members: DataFrame, last_ids: DataFrame, group: str = "dim",
    order: tuple[str, ...] = ("codigo", "subcodigo"), partitions: int | None = None,
) -> DataFrame:
    """Give new members the next ids of their dimension, in key order.

    Rows are range-partitioned and sorted by key and kept as a checkpoint;
    counts per partition give every partition its offset, so no task ever
    sees all rows. ``last_ids`` holds (group, last_id).
    """
    spark = members.sparkSession
    shared_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        members.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order).checkpoint()
    )
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_row", within)
    # One row per partition and group.
    counts = placed.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first")
    )
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .join(last_ids.select(group, "last_id"), group, "left")
        .select(group, "_part", (
            F.coalesce("last_id", F.lit(0)) + F.col("_before") - F.col("_first") + 1
        ).alias("_start"))
    )
    return (
        placed.join(F.broadcast(offsets), [group, "_part"])
        .select((F.col("_start") + F.col("_row")).cast("long").alias("id"), *members.columns)
    )
