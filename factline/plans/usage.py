"""Usage reports from log tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def job_usage(log: DataFrame, started: str, kind: str, ok: Column, amount: Column) -> DataFrame:
    """By day and type: jobs, how many succeeded and failed, and the sum of an amount."""
    keyed = log.groupBy(F.to_date(started).alias("day"), F.col(kind).alias("kind"))
    return keyed.agg(F.count(F.lit(1)).alias("jobs"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.sum(amount).alias("amount"))


def scoped_jobs(log: DataFrame, since: Column, until: Column, unlabelled: tuple[str, str], pattern: str, prefixes: tuple[str, ...], suffixes: tuple[str, ...]) -> DataFrame:
    """Finished jobs of a period that have to do with some tables, without scripts and those that carry the label ``unlabelled`` (key, value).

    They have if their query matches ``pattern``, or the destination or a referenced table's id begins with one of ``prefixes`` or its data set's ends
    with one of ``suffixes``. Labels and tables are arrays of structs and are looked at within their row.
    """
    any_of = lambda col, test, parts: reduce(lambda a, b: a | b, [test(F.coalesce(col, F.lit("")), F.lit(p)) for p in parts], F.lit(False))
    ours = lambda t: any_of(t["table_id"], F.startswith, prefixes) | any_of(t["dataset_id"], F.endswith, suffixes)
    none = lambda c: F.coalesce(c, F.lit(False))
    labelled = F.exists("labels", lambda x: (x["key"] == unlabelled[0]) & (x["value"] == unlabelled[1]))
    about = none(F.col("query").rlike(pattern)) | none(ours(F.col("destination_table"))) | none(F.exists("referenced_tables", ours))
    finished = (F.col("creation_time") >= since) & (F.col("creation_time") < until) & (F.col("state") == "DONE") & (F.coalesce("statement_type", F.lit("")) != "SCRIPT")
    return log.where(finished & ~none(labelled) & about)


def job_report(log: DataFrame) -> DataFrame:
    """By day and kind of work: jobs, outcomes, cache hits, bytes, slot time and duration; sums of nothing are 0."""
    kind = F.coalesce("statement_type", "job_type", F.lit("UNKNOWN")).alias("workload_type")
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    millis = F.timestamp_diff("MILLISECOND", F.col("start_time"), F.col("end_time"))
    aggs = [F.count(F.lit(1)).alias("job_count"), F.count_if(F.col("error_result").isNull()).alias("succeeded_job_count"), F.count_if(F.col("error_result").isNotNull()).alias("failed_job_count"), F.count_if("cache_hit").alias("cache_hit_count")]
    sums = [total(c, c) for c in ("total_bytes_processed", "total_bytes_billed", "total_slot_ms")]
    return log.groupBy(F.to_date("creation_time").alias("usage_date"), kind).agg(*aggs, *sums, total(millis, "total_duration_ms"))


def build_summary(results: DataFrame, run: str, elapsed: str, status: str) -> DataFrame:
    """By run: results, shortest, longest and average time to three places, and ``status_counts``, a sorted array of (status, n)."""
    each = results.groupBy(run, status).agg(F.count(F.lit(1)).alias("n"), F.sum(elapsed).alias("__sum"), F.min(elapsed).alias("__min"), F.max(elapsed).alias("__max"), F.count(elapsed).alias("__n"))
    counts = F.array_sort(F.collect_list(F.when(F.col(status).isNotNull(), F.struct(F.col(status).alias("status"), F.col("n").alias("n")))))
    return each.groupBy(run).agg(F.sum("n").alias("results"), F.min("__min").alias("shortest"), F.max("__max").alias("longest"), F.round(F.sum("__sum") / F.sum("__n"), 3).alias("average"), counts.alias("status_counts"))


def storage_usage(tables: DataFrame, dataset: str, size: str) -> DataFrame:
    """By data set, and for all of them (null)."""
    aggs = [F.count(F.lit(1)).alias("tables"), F.sum(size).alias("bytes")]
    each = tables.groupBy(F.col(dataset).cast("string").alias("dataset")).agg(*aggs)
    return each.unionByName(tables.agg(*aggs).withColumn("dataset", F.lit(None).cast("string")))


def storage_timeline(points: DataFrame, dataset: str, mib_seconds: str, at: str) -> DataFrame:
    """Average bytes of each day, from MiB seconds."""
    return points.groupBy(F.to_date(at).alias("day"), dataset).agg(F.expr(f"sum({mib_seconds}) * 1048576 div 86400").alias("average_bytes"))


def object_ages(inventory: DataFrame, updated: str, size: str, as_of: Column, group: str, edges=(7, 30, 90)) -> DataFrame:
    """By group and age: objects, bytes, oldest and newest."""
    age = F.date_diff(as_of, F.col(updated).cast("date"))
    label = F.lit(f"over {edges[-1]}")
    for edge in reversed(edges):
        label = F.when(age <= edge, f"to {edge}").otherwise(label)
    return inventory.groupBy(F.col(group).alias("storage_class"), label.alias("age")).agg(F.count(F.lit(1)).alias("objects"), F.sum(size).alias("bytes"), F.min(updated).alias("oldest"), F.max(updated).alias("newest"))


def message_totals(points: DataFrame, count: str, mean: str) -> DataFrame:
    """Messages, and bytes by their means, rounded half to even at each point."""
    return points.agg(F.sum(count).alias("messages"), F.sum(F.bround(F.col(count) * F.col(mean)).cast("long")).alias("bytes"))


def run_summary(results: DataFrame, group: str, elapsed: str, status: str) -> DataFrame:
    return results.groupBy(group).agg(F.count(F.lit(1)).alias("nodes"), F.min(elapsed).alias("shortest"), F.max(elapsed).alias("longest"), F.avg(elapsed).alias("average"), F.count_if(F.col(status) == "error").alias("errors"))


def expired_runs(inventory: DataFrame, run: str, name: str, updated: str, cutoff: Column, marker: str = "_SUCCESS") -> DataFrame:
    """Runs whose completion marker is older than the cutoff; incomplete and recent ones are left out."""
    done = inventory.groupBy(run).agg(F.max(F.when(F.col(name).endswith(marker), F.col(updated))).alias("completed_at"), F.count(F.lit(1)).alias("objects"))
    return done.where(F.col("completed_at") < cutoff)
