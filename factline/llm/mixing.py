"""Mixing sources to target weights, in DataFrame operations alone.

Targets: sources, in order of their names with null last, get the weights in turn and share all words by them;
no target passes ``most`` times its source's size, and what is left over is shared among the others (water
filling: the level is the largest of the levels that capping each prefix of sources gives).

Each source is a stream of its documents in random (hashed) order, repeated at most ``most`` times, and cut into
blocks of equal words; a document is in the block that its middle is in. The quota of a source is so many blocks as make
up its target exactly. A splitting tree deals the quotas to output shards: every node's blocks are halved at random,
which splits the sources' quotas by the multivariate hypergeometric law, down to the shards. A shard draws, for its
quota of a source, the next blocks of the stream in the source's permuted order, so no two shards share a block. What
the mix takes of a document is its copies in drawn blocks. :func:`mix` brings the rows of a shard together and shuffles
them there; the number of shards follows the words, so that a shard fits a task.

Places in a stream are prefix sums in two steps, over ``BUCKETS`` hash ranges of a source and within a range, so
a source with a third of all documents is spread over as many tasks. Sources and the tree's blocks are ranked in two
steps as well, so that neither many sources nor many shards meet in one task.

Defined results: null texts are empty; null sources are one source; null ids are hashed as such; repeated rows
have places of their own; empty documents weigh nothing; an empty table gives an empty mix; columns of the input
are kept in a struct, so their names don't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factline.sources.storage import write_shared

WEIGHTS, MOST, BLOCKS, BUCKETS, SEED = (5, 2, 1), 3, 64, 4096, 17
#: Least shards of a mix, most words of a shard that doesn't have to be one of them, and hash ranges of a node's blocks.
SHARDS, SHARD_WORDS, PARTS = 16, 1 << 26, 64
WORD = r"[^\x20\x09-\x0D]+"


def words(text_col: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")


def shards_for(total: int, least: int = SHARDS, most_words: int = SHARD_WORDS) -> int:
    """A power of two: the number of shards for so many words."""
    return max(least, 1 << (max(-(-total // most_words), 1) - 1).bit_length())


def sums_before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with sums over all rows before each in an order: over the parts of a distributed sort, and within each."""
    ordered = write_shared(df.orderBy(*order).withColumn("part", F.spark_partition_id()), "ordered")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    parts = parts.select("part", *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums))
    placed = ordered.join(F.broadcast(parts), "part")
    return placed.withColumns({n: F.col(f"_{n}") + F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()}).drop("part", *(f"_{n}" for n in sums))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(skey, source_size, target) from (skey, source, source_size); one row per source all through."""
    ranked = sums_before(sizes, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    total, weighed = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    levelled = sums_before(capped, [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_first()], {"caps": F.col("cap"), "lighter": F.col("weight")})
    level = levelled.agg(F.max((F.lit(total or 0) - F.col("caps")).cast("double") / (F.lit(weighed or 0) - F.col("lighter")).cast("double"))).first()[0]
    return levelled.select("skey", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level or 0.0)).alias("target"))


def splitting_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(skey, block, shard) for blocks 0 to quota - 1 of each row (skey, quota)."""
    tokens = quotas.where("quota > 0").select("skey", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("block"), F.lit(0).alias("node"))
    for level in range(depth):
        tokens = tokens.withColumn("hash", F.xxhash64(F.lit(seed + level), "node", "skey", "block"))
        tokens = write_shared(tokens.withColumn("part", F.pmod("hash", F.lit(PARTS)).cast("int")), "tree")
        # In a random order of a node's blocks, every other goes right: a half of them, chosen evenly.
        held = tokens.groupBy("node", "part").agg(F.count(F.lit(1)).alias("n"))
        earlier = F.coalesce(F.sum("n").over(Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rank = F.row_number().over(Window.partitionBy("node", "part").orderBy("hash", "skey", "block"))
        ranked = tokens.join(held.select("node", "part", earlier.alias("earlier")), ["node", "part"])
        tokens = ranked.select("skey", "block", (F.col("node") * 2 + (F.col("earlier") + rank) % 2).cast("int").alias("node"))
    tokens = write_shared(tokens, "tree")
    # The quota of a shard takes the next blocks of the source's permuted order.
    slot = F.row_number().over(Window.partitionBy("skey").orderBy("node", "block"))
    drawn = F.row_number().over(Window.partitionBy("skey").orderBy(F.xxhash64(F.lit(seed + depth), "skey", "block"), "block"))
    slots = tokens.select("skey", slot.alias("slot"), F.col("node").alias("shard"))
    return tokens.select("skey", "block", drawn.alias("slot")).join(slots, ["skey", "slot"]).select("skey", "block", "shard")


def place(df: DataFrame, id_col="doc_id", text_col="text", source_col="source", carry: bool = True, weights=WEIGHTS, most: int = MOST, shards: int | None = None, blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """One row per document: ``row`` (its columns, or only id and source without ``carry``), size, source_size, target, and
    ``copies``, an array with the block, shard and random key of each copy in a drawn block. ``shards``: a power of two."""
    key = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source_col)))
    own = F.struct("*") if carry else F.struct(id_col, source_col)
    mixed = F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col))
    docs = df.select(own.alias("row"), key.alias("skey"), F.col(source_col).alias("source"), words(text_col).alias("size"), mixed.alias("hash"))
    docs = docs.withColumn("bucket", F.shiftrightunsigned("hash", 64 - BUCKETS.bit_length() + 1).cast("int"))
    if not carry:
        docs = write_shared(docs, "sizes")
    buckets = write_shared(docs.groupBy("skey", "bucket").agg(F.sum("size").alias("held"), F.first("source").alias("source")), "buckets")
    sizes = buckets.groupBy("skey").agg(F.first("source").alias("source"), F.sum("held").alias("source_size"))
    total = buckets.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    shards = shards or shards_for(total)
    quota = F.ceil(F.col("target") / max(total / (shards * blocks), 1.0))
    sources = source_targets(sizes, weights, most).withColumn("quota", quota)
    sources = write_shared(sources.withColumn("unit", F.when(F.col("quota") > 0, F.col("target") / F.col("quota")).otherwise(1.0)), "targets")
    dealt = write_shared(splitting_tree(sources.select("skey", "quota"), shards.bit_length() - 1, seed), "dealt")

    # What a bucket needs: where it begins in the stream, and the shards of the blocks that it reaches in each pass.
    start = F.sum("held").over(Window.partitionBy("skey").orderBy("bucket")) - F.col("held")
    known = write_shared(buckets.withColumn("start", start).drop("source").join(sources, "skey"), "starts")
    block = lambda p, at: F.floor((F.col("source_size") * p + at) / F.col("unit"))
    reached = known.select("skey", "bucket", "source_size", "unit", "start", "held", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"))
    reached = reached.select("skey", "bucket", F.explode(F.sequence(block(F.col("pass"), F.col("start")), block(F.col("pass"), F.col("start") + F.col("held")))).alias("block")).distinct()
    drawn = reached.join(dealt, ["skey", "block"]).groupBy("skey", "bucket").agg(F.map_from_entries(F.collect_list(F.struct("block", "shard"))).alias("drawn"))
    known = known.select("skey", "bucket", "start", "source_size", "target", "unit").join(drawn, ["skey", "bucket"], "left")

    within = Window.partitionBy("skey", "bucket").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.withColumn("at", F.sum("size").over(within) - F.col("size")).join(known, ["skey", "bucket"])
    middle = F.col("start") + F.col("at") + F.col("size") / 2
    copy = lambda p: F.struct(block(p, middle).alias("block"), F.try_element_at("drawn", block(p, middle)).alias("shard"), F.xxhash64("hash", F.lit(p)).alias("key"))
    copies = F.filter(F.array(*map(copy, range(most))), lambda c: c["shard"].isNotNull())
    return placed.select("row", "size", "source_size", "target", copies.alias("copies"))


def mix(df: DataFrame, **options) -> DataFrame:
    """The mix: rows of ``df`` (``row``), as often as they are taken, and their ``shard`` and ``key``. A shard's rows are in one task, shuffled: in the order of the key."""
    copies = place(df, **options).select("row", F.explode("copies").alias("copy")).select("row", "copy.shard", "copy.key")
    return copies.repartition("shard").sortWithinPartitions("shard", "key")


def write_mix(df: DataFrame, path: str, **options) -> None:
    """Write the mix below ``path``, a folder ``shard=<number>`` for each shard, its rows in their shuffled order."""
    mix(df, **options).select("row.*", "shard").write.partitionBy("shard").parquet(path)
