"""Content-hashed snapshots, publication status, recheck buckets and receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factline.operators.relational import hashed
from factline.sources.storage import write_shared

#: Digits of a level of the snapshot's buckets, and rows of a bucket at most, on average.
_DIGITS, _ROWS = 3, 4096


def snapshot_hash(df: DataFrame, key: str, value: str, out: str = "snapshot_hash", rows: int = _ROWS) -> DataFrame:
    """One row: a hash of all (key, hash) rows, by a tree of buckets.

    Rows fall into buckets by the first digits of a hash of their key: three digits, or three more at a time until a bucket
    has at most ``rows`` of them. A bucket's sorted row hashes are hashed; then, level by level, the hashes of all buckets
    that share all digits but the last three, in order. No task holds more than its buckets, at any size of the table.
    """
    n, digits = df.count(), _DIGITS
    while n > rows * 16**digits:
        digits += _DIGITS
    joined = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda r: r["h"]), ",")
    bucket = F.left(F.md5(F.col(key).cast("string")), F.lit(digits))
    leaves = df.select(bucket.alias("bucket"), F.struct(F.col(key).cast("string").alias("k"), F.col(value).alias("v")).alias("r"))
    level = leaves.groupBy("bucket").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: F.concat(r["k"], F.lit(":"), r["v"])), ","), 256).alias("h"))
    for left in range(digits - _DIGITS, 0, -_DIGITS):
        level = level.groupBy(F.left("bucket", F.lit(left)).alias("parent")).agg(F.sha2(joined(), 256).alias("h")).withColumnRenamed("parent", "bucket")
    return level.agg(F.sha2(joined(), 256).alias(out))


def manifest(tables: dict[str, tuple[DataFrame, str, str]], watermark: DataFrame, prefix: str = "pub_") -> DataFrame:
    """One row: count and snapshot hash of each (table, key, hash column), the watermark, and an id from all."""
    row = watermark
    for name, (df, key, value) in tables.items():
        row = row.crossJoin(df.agg(F.count(F.lit(1)).alias(f"{name}_count"))).crossJoin(snapshot_hash(df, key, value, f"{name}_hash"))
    combined = F.sha2(F.concat_ws("|", *(f"{n}_hash" for n in tables)), 256)
    return row.withColumn("content_hash", combined).withColumn("publication_id", F.concat(F.lit(prefix), F.left("content_hash", F.lit(16))))


def publication_status(df: DataFrame, as_of: Column, rules: list[tuple[str, Column]]) -> DataFrame:
    """Status and the reason of the first rule that fails; rules that are null count as failed."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(rules):
        reason = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    return df.withColumn("reason", reason).withColumn("publication_status", F.when(F.col("reason").isNull(), "PUBLISHABLE").otherwise("NOT_PUBLISHABLE"))


def not_expired(valid_through: Column, date_only: Column, as_of: Column) -> Column:
    """Whether a validity still holds: a date through its day, a timestamp exactly; none holds for ever."""
    end = F.when(date_only, F.date_trunc("day", valid_through) + F.expr("INTERVAL 1 DAY")).otherwise(valid_through)
    return valid_through.isNull() | (end > as_of)


def assign_buckets(rows: DataFrame, existing: DataFrame, key: str, group: str, buckets: int = 7) -> DataFrame:
    """Append-only buckets: known keys keep theirs; new ones follow the last position of their group, in the order of keys.

    New rows are dealt by ranges of (group, key), so that a large group spreads over many tasks, and written with their
    range. A position is the number of the group's rows in earlier ranges and the rank within the own one.
    """
    last = existing.groupBy(group).agg(F.max("position").alias("__last"))
    fresh = rows.select(key, group).join(existing.select(key), key, "left_anti")
    dealt = write_shared(fresh.repartitionByRange(group, key).select(key, group, F.spark_partition_id().alias("__range")), "positions")
    earlier = F.sum("__n").over(Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = dealt.groupBy(group, "__range").agg(F.count(F.lit(1)).alias("__n")).withColumn("__earlier", F.coalesce(earlier, F.lit(0)))
    starts = starts.join(last, group, "left").select(F.col(group).alias("__group"), F.col("__range").alias("__of"), (F.coalesce("__last", F.lit(0)) + F.col("__earlier")).alias("__start"))
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy(group, "__range").orderBy(key)))
    fresh = ranked.join(starts, (F.col("__range") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group")))
    fresh = fresh.withColumn("position", (F.col("__start") + F.col("__rank")).cast("long"))
    start = F.conv(F.substring(F.md5(F.col(group).cast("string")), 1, 15), 16, 10).cast("long")
    fresh = fresh.withColumn("bucket", F.pmod(start + F.col("position"), F.lit(buckets)).cast("int"))
    return existing.select(key, group, "position", "bucket").unionByName(fresh.select(key, group, "position", "bucket"))


def due_bucket(assignments: DataFrame, epoch_seconds: int, slot_seconds: int = 43200, buckets: int = 7) -> DataFrame:
    return assignments.where(F.col("bucket") == epoch_seconds // slot_seconds % buckets)


def latest_ready(control: DataFrame) -> DataFrame:
    return control.where(F.col("status") == "READY").orderBy(F.col("created_at").desc(), F.col("publication_id").desc()).limit(1)


def verify_receipts(control: DataFrame, receipts: DataFrame, accepted=("APPLIED", "ACCEPTED")) -> DataFrame:
    """The latest ready publication if its latest receipt isn't an accepted one."""
    last = receipts.groupBy("publication_id").agg(F.max_by("status", "received_at").alias("receipt_status"))
    return latest_ready(control).join(last, "publication_id", "left").where(~F.coalesce(F.col("receipt_status").isin(*accepted), F.lit(False)))


def verify_manifest(actual: DataFrame, tables: dict[str, tuple[DataFrame, str, str]], watermark: DataFrame, prefix: str = "pub_") -> DataFrame:
    """A row (column, actual, expected) for each column of the one-row ``actual`` that differs from the manifest made anew, and for its number of rows unless that is one."""
    expected = manifest(tables, watermark, prefix)
    columns = [c for c in actual.columns if c in expected.columns]
    both = actual.select(F.struct(*columns).alias("a")).crossJoin(F.broadcast(expected.select(F.struct(*columns).alias("e"))))  # one row
    text = lambda side, c: F.col(side)[c].cast("string")
    each = both.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), text("a", c).alias("actual"), text("e", c).alias("expected")) for c in columns))))
    rows = actual.agg(F.count(F.lit(1)).cast("string").alias("actual")).select(F.lit("rows").alias("column"), "actual", F.lit("1").alias("expected"))
    return each.unionByName(rows).where(~F.col("actual").eqNullSafe(F.col("expected")))


def latest_reviews(reviews: DataFrame, key: str, updated: str) -> DataFrame:
    """The last decision on each key, as a whole row; of equal times the one that sorts last."""
    rest = [c for c in reviews.columns if c != key]
    return reviews.dropna(subset=[key]).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(updated, *(c for c in rest if c != updated))).alias("r")).select(key, "r.*")


def confirmed_closure(status: Column, previous: Column) -> Column:
    """Whether a lifecycle is over: closed, or terminal twice in a row."""
    return F.coalesce((status == "CLOSED") | ((status == "TERMINAL") & (previous == "TERMINAL")), F.lit(False))


def closure_reason(status: Column, previous: Column) -> Column:
    """Why a lifecycle is over, null if it isn't: LIFECYCLE_CLOSED, or LIFECYCLE_TERMINAL_CONFIRMED if it was terminal twice in a row."""
    return F.when(confirmed_closure(status, previous), F.when(status == "CLOSED", "LIFECYCLE_CLOSED").otherwise("LIFECYCLE_TERMINAL_CONFIRMED"))


def apply_reviews(rows: DataFrame, reviews: DataFrame, key: str, content: list[tuple[str, Column]], closed: Column, expired: Column, updated: str = "review_updated_at", holds=("pending", "held")) -> DataFrame:
    """``rows`` with review_status, publication_status and the reason of the first rule that decides.

    In order: a rule of ``content`` that fails or is null makes a row NOT_PUBLISHABLE, a confirmed closure (``closed``, its reason or null) CLOSED, then an
    ended validity and a review that holds NOT_PUBLISHABLE; all others are PUBLISHABLE. Reviews are hashed and rows stream past them, so that wide rows are never sorted.
    """
    joined = rows.join(hashed(latest_reviews(reviews, key, updated).select(key, "review_status")), key, "left")
    steps = [(name, ~F.coalesce(holds_, F.lit(False)), "NOT_PUBLISHABLE") for name, holds_ in content]
    steps += [(closed, closed.isNotNull(), "CLOSED"), ("EXPIRED_VALID_THROUGH", expired, "NOT_PUBLISHABLE"), ("PUBLICATION_REVIEW_HELD", F.col("review_status").isin(*holds), "NOT_PUBLISHABLE")]
    reason, status = F.lit("PUBLICATION_READY"), F.lit("PUBLISHABLE")
    for name, hit, outcome in reversed(steps):
        reason, status = F.when(F.coalesce(hit, F.lit(False)), name).otherwise(reason), F.when(F.coalesce(hit, F.lit(False)), outcome).otherwise(status)
    return joined.withColumns({"publication_status": status, "reason": reason})


def recheck_eligible(serving: DataFrame, key: str, sources: list[str], published: str, as_of: Column, min_age_days: int = 21, deleted: str = "is_deleted") -> DataFrame:
    """(key, source_key) of active rows published at least ``min_age_days`` ago, or at an unknown time. ``source_key``: the first of ``sources`` that isn't blank, else the key."""
    first = F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in sources), F.col(key).cast("string"))
    old = F.col(published).isNull() | (F.col(published) <= as_of - F.make_dt_interval(F.lit(min_age_days)))
    active = ~F.coalesce(F.col(deleted), F.lit(False)) & (F.length(F.coalesce(F.col(key).cast("string"), F.lit(""))) > 0)
    return serving.where(active & old).select(key, first.alias("source_key"))
