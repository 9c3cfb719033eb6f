"""Mix sources to target weights: exact block quotas, dealt among output shards by a splitting tree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aforo.llm.common import WORD, documents, stored
from aforo.operators.members import assign_member_ids

WEIGHTS = (3, 1, 2)
SHARE = 1.5
#: No source is taken more often than this.
REPEATS = 2
SEED = 20_260_731
#: Words of a block, and of the finer blocks a block is divided into where the quota ends inside it.
BLOCK_WORDS = 65_536
FINE_WORDS = 16_384
#: Blocks of a source, and fine blocks of a block; beyond that they get larger, not more.
BLOCKS = 4_096
#: Words of an output shard.
SHARD_WORDS = 4 << 20


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """The number that decides on a row: the same in every run."""
    return F.xxhash64(F.lit(SEED), doc_id, F.octet_length(F.coalesce(text, F.lit(""))))


def _part(key: Column | str, salt: int, parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), key), parts)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """sid, source, source_size, target, from (source, source_size).

    Weights go round by rank of the source in code-point order, missing last.
    The water level that fills the targets is found by resharing: sources whose
    share is above their bound leave with the bound, the rest share what is left.
    Only sums come to the driver.
    """
    spark = sizes.sparkSession
    ranked = assign_member_ids(
        sizes.select(F.lit(0).alias("dim"), F.col("source").isNull().alias("last"),
                     F.coalesce("source", F.lit("")).alias("name"), "source", "source_size"),
        spark.createDataFrame([(0, -1)], "dim int, last_id long"), order=("last", "name"))
    weighed = stored(ranked.select(
        F.col("id").alias("sid"), "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (F.pmod("id", F.lit(len(weights))) + 1).cast("int")).alias("weight"),
    ), "mix-sources")
    bound = REPEATS * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while total:
        above = F.col("weight") * level >= bound
        got = weighed.agg(
            F.sum(F.when(above, bound)).alias("spent"), F.sum(F.when(~above, F.col("weight"))).alias("free"),
            F.count(F.when(above, 1)).alias("full")).first()
        if got.full == full or not got.free:
            break
        full, level = got.full, (share * total - (got.spent or 0)) / got.free
    return weighed.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), bound.cast("double")))


def _draw(parts: DataFrame, part: str, salt: int) -> DataFrame:
    """Whole parts in permuted order while they fit into what is ``left``; the next one is the edge.

    ``parts``: sid, ``part``, words, left; at most BLOCKS rows of a source.
    """
    order = F.xxhash64(F.lit(salt), "sid", part)
    until = Window.partitionBy("sid").orderBy(order, part).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.sum("words").over(until)
    return (
        parts.withColumn("reached", reached)
        .withColumn("whole", F.col("reached") <= F.col("left"))
        .withColumn("edge", ~F.col("whole") & (F.col("reached") - F.col("words") < F.col("left")))
        .withColumn("left", F.col("left") - F.col("reached") + F.col("words"))
        .drop("reached")
    )


def _fill(units: DataFrame, rounds: int = 4) -> DataFrame:
    """Documents of the last edge: in permuted order, again and again what still fits; (sid, key)."""
    order = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(SEED + 5), "key"), "key")
    until, every = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("sid")
    state = units.withColumn("picked", F.lit(False))
    for _ in range(rounds):
        fits = ~F.col("picked") & (F.col("words") <= F.col("left"))
        state = (
            state.withColumn("reached", F.sum(F.when(fits, F.col("words")).otherwise(0)).over(until))
            .withColumn("now", fits & (F.col("reached") <= F.col("left")))
            .withColumn("left", F.col("left") - F.coalesce(F.max(F.when(F.col("now"), F.col("reached"))).over(every), F.lit(0)))
            .withColumn("picked", F.col("picked") | F.col("now"))
            .drop("reached", "now")
        )
    # Last, the one document that comes closer to the quota by going over it.
    nearest = F.row_number().over(Window.partitionBy("sid").orderBy("picked", F.abs(F.col("words") - F.col("left")), "key"))
    over = ~F.col("picked") & (F.col("nth") == 1) & (F.col("words") < 2 * F.col("left"))
    return state.withColumn("nth", nearest).where(F.col("picked") | over).select("sid", "key")


def splitting_tree(quotas: DataFrame, levels: int) -> DataFrame:
    """Deal the blocks of all sources among 2^levels shards; (sid, shard, n).

    ``quotas``: sid, n. Every node halves its blocks without replacement: how
    many of each source go left follows the multivariate hypergeometric
    distribution, drawn source after source from its conditional distributions,
    each by selection sampling over that source's blocks. The table has a row
    for each node and an entry for each source, never for a document.
    """
    tree = quotas.agg(F.array_sort(F.collect_list(F.struct("sid", "n"))).alias("q")).select(F.lit(0).alias("node"), "q")
    unit = float(1 << 53)

    def uniform(level: int, sid: Column, nth: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED + 7 + level), F.col("node"), sid, nth), F.lit(1 << 53)) / F.lit(unit)

    def one_source(level: int):
        def step(a: Column, s: Column) -> Column:
            drawn = F.aggregate(
                F.when(s.n > 0, F.sequence(F.lit(1).cast("long"), s.n)).otherwise(F.array().cast("array<bigint>")),
                F.struct(a.rest.alias("rest"), a.want.alias("want"), F.lit(0).cast("long").alias("x")),
                lambda b, i: F.transform(
                    F.array((uniform(level, s.sid, i) * b.rest < b.want).cast("long")),
                    lambda hit: F.struct((b.rest - 1).alias("rest"), (b.want - hit).alias("want"), (b.x + hit).alias("x")),
                )[0],
            )
            return F.transform(F.array(drawn), lambda b: F.struct(
                b.rest.alias("rest"), b.want.alias("want"),
                F.concat(a.left, F.array(F.struct(s.sid.alias("sid"), b.x.alias("n")))).alias("left")))[0]
        return step

    empty = F.array().cast("array<struct<sid:bigint,n:bigint>>")
    for level in range(levels):
        blocks = F.aggregate("q", F.lit(0).cast("long"), lambda a, s: a + s.n)
        state = F.struct(F.col("blocks").alias("rest"), F.floor(F.col("blocks") / 2).alias("want"), empty.alias("left"))
        halves = tree.withColumn("blocks", blocks).withColumn("l", F.aggregate("q", state, one_source(level)).left)
        right = F.zip_with("q", "l", lambda q, x: F.struct(q.sid.alias("sid"), (q.n - x.n).alias("n")))
        tree = halves.select("node", F.posexplode(F.array(F.col("l"), right)).alias("side", "q")).select(
            (F.col("node") * 2 + F.col("side")).alias("node"), "q")
    return tree.select(F.col("node").alias("shard"), F.inline("q")).select("sid", "shard", "n")


class Mix:
    """What was decided: ``sources`` (one row each) and ``blocks`` (one row per source and block)."""

    def __init__(self, sources: DataFrame, blocks: DataFrame, shards: int):
        self.sources, self.blocks, self.shards = sources, blocks, shards


def plan_mix(rows: DataFrame, weights=WEIGHTS, share: float = SHARE) -> Mix:
    """Decide on (source, size, key) rows; all intermediate tables are sums by source and block."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = stored(targets.select(
        "sid", "source", "source_size", "target", passes.cast("int").alias("passes"),
        (F.col("target") - passes * F.col("source_size")).alias("left"),
        F.least(F.lit(BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS))).cast("int").alias("parts"),
    ), "mix-targets")
    dealt = join_source(rows.where("size > 0"), sources).withColumn("block", _part("key", SEED + 1, F.col("parts")))

    blocks = stored(_draw(
        dealt.groupBy("sid", "block", "passes", "left").agg(F.sum("size").alias("words")), "block", SEED + 2), "mix-blocks")
    # Where a source's quota ends inside a block, the block is drawn from in finer blocks, and the last of these by document.
    edge = blocks.where("edge").select("sid", "block", "left", F.least(
        F.lit(BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("words") / FINE_WORDS))).cast("int").alias("fines"))
    inside = dealt.drop("left").join(edge, ["sid", "block"]).withColumn("fine", _part("key", SEED + 3, F.col("fines")))
    fine = stored(_draw(
        inside.groupBy("sid", "block", "fines", "left", "fine").agg(F.sum("size").alias("words")), "fine", SEED + 4), "mix-fine")
    open_rows = inside.drop("left").join(fine.where("edge").select("sid", "fine", "left"), ["sid", "fine"])
    picks = _fill(open_rows.groupBy("sid", "key", "left").agg(F.sum("size").alias("words")))
    edges = (
        fine.groupBy("sid", "block", "fines").agg(
            F.collect_list(F.when(F.col("whole"), F.col("fine"))).alias("fine_whole"))
        .join(picks.groupBy("sid").agg(F.collect_set("key").alias("picks")), "sid", "left")
    )

    draws = F.col("passes") + (F.col("whole") | F.col("edge")).cast("int")
    units = stored(blocks.where(draws > 0).select(
        "sid", "block", F.explode(F.sequence(F.lit(1), draws)).alias("nth")), "mix-units")
    taken = units.count()
    words = sources.agg(F.sum("target")).first()[0] or 0.0
    levels = max(0, min(math.ceil(math.log2(max(1.0, words / SHARD_WORDS))), int(math.log2(max(1, taken)))))
    quotas = splitting_tree(units.groupBy("sid").agg(F.count(F.lit(1)).alias("n")), levels)
    up_to = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    places = (
        quotas.withColumn("end", F.sum("n").over(up_to)).where("n > 0")
        .select("sid", "shard", F.explode(F.sequence(F.col("end") - F.col("n") + 1, F.col("end"))).alias("place"))
    )
    permuted = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(SEED + 6), "sid", "block", "nth"), "block", "nth")
    dealt_out = (
        units.withColumn("place", F.row_number().over(permuted).cast("long")).join(places, ["sid", "place"])
        .groupBy("sid", "block").agg(F.array_sort(F.collect_list(F.struct("nth", "shard"))).shard.alias("shards"))
    )
    decided = (
        blocks.select("sid", "block", "whole", "edge").join(edges, ["sid", "block"], "left")
        .join(dealt_out, ["sid", "block"], "left")
    )
    return Mix(sources, stored(decided, "mix-decided"), 1 << levels)


def join_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's figures; a missing source is a source."""
    return rows.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def place_rows(rows: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` (source, size, key and any others) with source_size, target, copies and shards (one for each copy)."""
    known = join_source(rows, mix.sources.drop("left")).withColumn("block", _part("key", SEED + 1, F.col("parts")))
    placed = known.join(mix.blocks, ["sid", "block"], "left")
    in_fine = F.array_contains("fine_whole", _part("key", SEED + 3, F.col("fines")))
    extra = F.col("whole") | (F.col("edge") & (in_fine | F.coalesce(F.array_contains("picks", F.col("key")), F.lit(False))))
    copies = F.when(F.col("size") > 0, F.col("passes") + F.coalesce(extra, F.lit(False)).cast("int")).otherwise(0)
    return (
        placed.withColumn("copies", copies)
        .withColumn("shards", F.when(F.col("copies") > 0, F.slice("shards", F.lit(1), F.col("copies"))).otherwise(F.array().cast("array<int>")))
        .drop("sid", "block", "passes", "parts", "whole", "edge", "fines", "fine_whole", "picks")
    )


def mix_sources(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and shards of every document.

    Every source's words taken come within a document of its target: whole
    passes over the source, then permuted blocks without replacement, then
    finer blocks and documents where the quota ends inside a block. A document
    is taken 0 to 2 times as a whole, so never more than twice its size.

    A missing text has size 0 and is taken 0 times; a missing source is a
    source, ranked last. Rows with the same id and text length are decided on
    together. No rows give no rows. Other columns are ignored.
    """
    rows = stored(docs.select(
        "doc_id", "source", words_in(F.col("text")).alias("size"), row_key(F.col("doc_id"), F.col("text")).alias("key"),
    ), "mix-rows")
    return place_rows(rows, plan_mix(rows)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "shards")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixture itself: every copy of a document as a row, shard by shard, shuffled within each shard."""
    names = docs.columns
    sized = docs.select(
        F.struct(*names).alias("doc"), "source", words_in(F.col("text")).alias("size"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"))
    mix = plan_mix(stored(sized.drop("doc"), "mix-rows"))
    copies = place_rows(sized, mix).select("doc", "key", F.posexplode("shards").alias("nth", "shard"))
    return (
        copies.repartition(mix.shards, "shard")
        .sortWithinPartitions("shard", F.xxhash64(F.lit(SEED + 8), "key", "nth"), "key", "nth").select("doc.*")
    )


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))
