"""Exact deduplication with a heavy-hitter split.

Each text becomes its SHA-256 digest. Misra-Gries summaries, one per partition, find every digest that can
make up more than ``2 / (counters + 1)`` of all rows; their exact sizes and winners are then counted (partial
aggregates, so a hot digest sends one row per task) and broadcast: at most ``counters + 1`` rows whatever the
input. Rows with these digests never meet in a task. All other digests are rare by then, and are shuffled.

Defined results: a null text equals an empty one; a null id ranks below every other; of rows that repeat both
id and text, one stays; an empty table gives an empty result; other columns may have any name, as columns
made here live only in the narrow tables of this module.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factline.sources.storage import write_shared

COUNTERS = 1023


def digest(text_col: str):
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


def misra_gries(counts: dict, more: dict, counters: int) -> dict:
    """Add exact counts to a summary; if over ``counters`` keys are held, subtract the first count too many from all."""
    for k, n in more.items():
        counts[k] = counts.get(k, 0) + n
    if len(counts) > counters:
        cut = sorted(counts.values(), reverse=True)[counters]
        counts = {k: n - cut for k, n in counts.items() if n > cut}
    return counts


def heavy_hitters(rows: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """Keys (string column ``key``, not null) that may make up more than ``2 / (counters + 1)`` of the rows: all such, at most ``counters + 1`` in all."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        total = 0
        for batch in batches:
            total += len(batch)
            counts = misra_gries(counts, Counter(batch.column(0).to_pylist()), counters)
        columns = [[*counts, None], [*counts.values(), 0], [*[0] * len(counts), total]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=[key, "n", "seen"])

    partial = rows.select(key).mapInArrow(summarise, f"{key} string, n long, seen long")
    summed = partial.groupBy(key).agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    summed = write_shared(summed, "heavy")
    total = summed.agg(F.sum("seen")).first()[0] or 0
    return summed.where(F.col(key).isNotNull() & (F.col("n") > total / (counters + 1))).select(key)


def _winners(rows: DataFrame, counters: int) -> DataFrame:
    """(digest, keep_id, keep_uid, group_size) of the heavy digests, counted exactly."""
    heavy = heavy_hitters(rows, "digest", counters)
    return (
        rows.join(F.broadcast(heavy), "digest")
        .groupBy("digest")
        .agg(F.max(F.struct("id", "uid")).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.id").alias("keep_id"), F.col("best.uid").alias("keep_uid"), "group_size")
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``df``: ``id_col``, keep_id, group_size, kept, text_sha256."""
    rows = write_shared(df.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("uid")), "digests")
    winners = write_shared(_winners(rows, counters), "winners")
    frequent = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("best", F.max(F.struct("id", "uid")).over(group))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
        .select("digest", "id", "uid", F.col("best.id").alias("keep_id"), F.col("best.uid").alias("keep_uid"), "group_size")
    )
    return frequent.unionByName(rest).select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``df`` that stay, with its columns. Rows of heavy digests are removed before the shuffle."""
    rows = write_shared(df.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.lit(0).alias("uid")), "digests")
    winners = F.broadcast(write_shared(_winners(rows, counters), "winners").select("digest", F.struct("keep_id").alias("winner")))
    whole = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), digest(text_col).alias("digest"))
    candidates = whole.join(winners, "digest", "left").where(F.col("winner").isNull() | F.col("winner.keep_id").eqNullSafe(F.col("id")))
    order = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last())
    return candidates.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("row.*")
