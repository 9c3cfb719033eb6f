"""Connected components of an edge table, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import discard, stored


def _hook(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step on edges (u, v), u > v: neighbours are linked to the least of a node and its neighbours.

    A large-star step looks at both ends of an edge and moves the larger
    neighbours; a small-star step looks at the larger end and moves all of
    them. A node with many neighbours is a minimum folded before the shuffle
    and a join that can be split; its neighbours are never gathered.
    """
    both = edges if not larger_only else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if larger_only:
        linked = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return linked.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b); the label is the least node of the component.

    Large-star and small-star steps alternate until nothing changes, which
    takes a number of rounds that grows with the logarithm of the graph. Every
    round is a stored table, so a lost executor repeats one round at most; the
    table of the round before is deleted when the next one is complete.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "cc")
    before = None
    while True:
        last, current = current, stored(_hook(_hook(current, True), False), "cc")
        discard(last)
        mark = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
