"""The latest receipt of each publication, kept as state of a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factline.operators.incremental import commit_parts, current_parts, expire_snapshots, read_parts
from factline.operators.publication import verify_receipts
from factline.sources.storage import release_table, write_shared


def latest_receipts(receipts: DataFrame, lateness: str, horizon: str = "30 days") -> DataFrame:
    """A stream of (publication_id, opened, status, received_at): each publication's latest receipt by ``received_at``, emitted whenever it changes.

    State is one row for each publication and period of ``horizon``. Receipts later than ``lateness`` behind the newest are dropped once the
    period they belong to is over, and state of periods that are over goes; so it is bounded by the publications of the
    last two periods. Repeated and out-of-order receipts change nothing; of equal times the greatest status stays. Null ids, times and
    statuses are left out.
    """
    known = receipts.where("publication_id IS NOT NULL AND received_at IS NOT NULL AND status IS NOT NULL")
    timed = known.withColumn("received_at", F.col("received_at").cast("timestamp")).withWatermark("received_at", lateness)
    last = timed.groupBy("publication_id", F.window("received_at", horizon)).agg(F.max(F.struct("received_at", "status")).alias("last"))
    return last.select("publication_id", F.col("window.start").alias("opened"), "last.status", "last.received_at")


def stream_receipts(source: DataFrame, target: str, checkpoint: str, lateness: str = "1 day", horizon: str = "30 days", keep: int = 2) -> StreamingQuery:
    """Keep the table at ``target`` at the latest receipts that the stream's state gives. A batch that is run again, after a failure, gives the same table.

    The table has a part for each period in which publications' receipts came, and a batch rewrites the parts of the periods that changed.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        # A period's part is named by its first day; few periods are open at once.
        rows = batch.withColumn("bucket", F.date_diff(F.col("opened").cast("date"), F.lit("1970-01-01").cast("date")))
        rows = write_shared(rows, "receipts")  # the stream's state is gone through once
        touched = {r.bucket for r in rows.select("bucket").distinct().collect()}
        if not touched:
            release_table(rows)
            return
        parts = current_parts(spark, target)
        known = [p for p in parts if p[0] in touched]
        cols = ["publication_id", "status", "received_at", "bucket"]
        before = [read_parts(spark, target, [p]).withColumn("bucket", F.lit(p[0])).select(*cols) for p in known]
        both = rows.select(*cols)
        for part in before:
            both = both.unionByName(part)
        newest = both.groupBy("publication_id", "bucket").agg(F.max(F.struct("received_at", "status")).alias("last")).select("publication_id", "last.status", "last.received_at", "bucket")
        name = uuid.uuid4().hex
        newest.write.partitionBy("bucket").parquet(f"{target}/snapshot={name}")
        commit_parts(spark, target, [p for p in parts if p[0] not in touched] + [(b, name) for b in sorted(touched)])
        expire_snapshots(spark, target, keep)
        release_table(rows)

    return latest_receipts(source, lateness, horizon).writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def received(spark: SparkSession, target: str) -> DataFrame | None:
    """(publication_id, status, received_at) of the latest receipt of each publication; none before the first batch."""
    parts = current_parts(spark, target)
    if not parts:
        return None
    rows = read_parts(spark, target, parts)
    return rows.groupBy("publication_id").agg(F.max(F.struct("received_at", "status")).alias("last")).select("publication_id", "last.status", "last.received_at")


def unapplied(spark: SparkSession, control: DataFrame, target: str) -> DataFrame:
    """The latest ready publication if the stream's latest receipt of it isn't an accepted one, or there is none."""
    seen = received(spark, target)
    return verify_receipts(control, spark.createDataFrame([], "publication_id long, status string, received_at timestamp") if seen is None else seen)
