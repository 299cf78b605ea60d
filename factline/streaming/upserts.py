"""Current-state tables kept up by a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factline.operators.incremental import commit_parts, current_parts, expire_snapshots, latest_per_key, read_parts
from factline.sources.storage import list_files, release_table, write_shared

#: Rows of a part from which it is cut in two, or more; the most cuts of a part.
PART_ROWS, DEEPEST = 4_000_000, 30


def _numbered(hash_col: str, level: Column | int) -> Column:
    """The part of a hash at a level: of level 0 there is part 1, and part p is cut into two that end in p's last bits."""
    size = F.call_function("shiftleft", F.lit(1), F.lit(level))
    return (size + F.col(hash_col).bitwiseAND(size - 1)).cast("int")


def _dealt(rows: DataFrame, parts: list[int]) -> DataFrame:
    """``rows`` with the part that each is in, of parts such that any hash is in one of them."""
    levels = sorted({b.bit_length() - 1 for b in parts})
    at = F.explode(F.array(*(_numbered("__hash", level) for level in levels)))
    return rows.withColumn("bucket", at).join(rows.sparkSession.createDataFrame([(b,) for b in parts], "bucket int"), "bucket", "left_semi")


def stream_upsert(source: DataFrame, target: str, checkpoint: str, key: list[str], order: list[str], part_rows: int = PART_ROWS, keep: int = 2) -> StreamingQuery:
    """Merge each micro-batch into the table at ``target``: the newest row of a key by ``order`` stays, of equals the one with the greatest hash of all its columns.

    So rows have a total order: late rows don't undo newer ones, and a replay changes nothing. The table's parts are ranges of a hash
    of the key. A batch rewrites the parts that its keys fall into and no other; a part that comes to over ``part_rows`` rows is
    cut in two or more as it is rewritten, so their number follows the table, and none grows beyond a task. The last ``keep`` versions stay
    readable. Rows with a null in their key are left out.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropna(subset=key).withColumn("__hash", F.xxhash64(*key).bitwiseAND(F.lit((1 << DEEPEST) - 1)))
        parts = current_parts(spark, target)
        known = [b for b, _ in parts] or [1]
        rows = write_shared(_dealt(rows, known), "upserts")  # a batch is read once, and its newest rows are looked for once
        landed = rows
        counts = {r.bucket: r["count"] for r in rows.groupBy("bucket").count().collect()}  # a row for each part that the batch touches
        if not counts:
            release_table(landed)
            return
        touched = [p for p in parts if p[0] in counts]
        if touched:
            old = read_parts(spark, target, touched).withColumn("__hash", F.xxhash64(*key).bitwiseAND(F.lit((1 << DEEPEST) - 1)))
            rows = _dealt(old, known).unionByName(rows, allowMissingColumns=True)
        columns = [c for c in rows.columns if c not in ("__hash", "bucket")]
        tie = F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
        merged = write_shared(latest_per_key(rows.withColumn("__tie", tie), key, [*order, "__tie"]).drop("__tie"), "merged")
        sizes = {r.bucket: r["count"] for r in merged.groupBy("bucket").count().collect()}
        cuts = [(b, min(DEEPEST, b.bit_length() - 1 + (-(-n // part_rows) - 1).bit_length())) for b, n in sizes.items()]
        levels = spark.createDataFrame(cuts, "bucket int, __level int")
        placed = merged.join(levels, "bucket").withColumn("bucket", _numbered("__hash", F.col("__level"))).select(*columns, "bucket")
        name = uuid.uuid4().hex
        placed.repartition("bucket").write.partitionBy("bucket").parquet(f"{target}/snapshot={name}")
        fresh = {b for own, level in cuts for b in _below(own, level)}
        there = {int(x.removeprefix("bucket=")) for x in list_files(spark, f"{target}/snapshot={name}") if x.startswith("bucket=")}
        empty = spark.createDataFrame([], merged.select(*columns).schema)
        for b in sorted(fresh - there):  # a part that no key is in is still a part
            empty.write.parquet(f"{target}/snapshot={name}/bucket={b}")
        commit_parts(spark, target, [p for p in parts if p[0] not in counts] + [(b, name) for b in sorted(fresh)])
        expire_snapshots(spark, target, keep)
        for table in (landed, merged):
            release_table(table)

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _below(part: int, level: int) -> list[int]:
    """The parts of a level that a part is cut into."""
    own = part.bit_length() - 1
    low = part - (1 << own)
    return [(1 << level) + low + (i << own) for i in range(1 << (level - own))]
