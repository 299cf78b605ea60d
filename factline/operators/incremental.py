"""Current-state tables from append-only observations."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factline.sources.storage import create_file, delete_folder, list_files


def _recent_first(order: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def latest_per_key(df: DataFrame, key: list[str], order: list[str], narrow: str | None = None) -> DataFrame:
    """The newest row of each key by ``order`` (descending, null last); null keys are dropped.

    With ``narrow``, a unique id of rows, keys and order alone are ranked and the wide rows fetched by a join.
    """
    df = df.dropna(subset=key)
    window = Window.partitionBy(*key).orderBy(*_recent_first(order))
    if narrow:
        best = df.select(narrow, *key, *(c for c in order if c not in (narrow, *key))).withColumn("__rank", F.row_number().over(window)).where("__rank = 1")
        return df.join(best.select(narrow), narrow, "left_semi")
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def with_previous(df: DataFrame, key: list[str], order: list[str], col: str, out: str) -> DataFrame:
    """The newest row of each key, with ``col`` of the one before it."""
    window = Window.partitionBy(*key).orderBy(*_recent_first(order))
    ranked = df.dropna(subset=key).withColumns({"__rank": F.row_number().over(window), out: F.lead(col).over(window)})
    return ranked.where("__rank = 1").drop("__rank")


def changed_keys(source: DataFrame, target: DataFrame, key: list[str], ts: str) -> DataFrame:
    """Keys with a row newer than all of the target's, or absent from it."""
    newest = target.agg(F.max(ts).alias("__newest"))
    newer = source.join(F.broadcast(newest)).where(F.col(ts) > F.col("__newest")).select(*key)
    absent = source.select(*key).join(target.select(*key), key, "left_anti")
    return newer.unionByName(absent).dropna().distinct()


def changed_keys_multi(inputs: list[tuple[DataFrame, DataFrame, str]], key: list[str]) -> DataFrame:
    """Changed keys of several (source, target, timestamp) inputs."""
    out = None
    for source, target, ts in inputs:
        found = changed_keys(source, target, key, ts)
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def upsert(target: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The target with changed rows replaced and new ones added; columns that only one side has are null on the other."""
    return target.join(changes.select(*key), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def changed_rows(new: DataFrame, old: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Rows of ``new`` that are absent from ``old`` or differ in ``cols``."""
    before = old.select(*key, F.struct(*cols).alias("__old"))
    return new.join(before, key, "left").where(~F.struct(*cols).eqNullSafe(F.col("__old"))).drop("__old")


def suppress(previous: DataFrame, status: DataFrame, key: list[str], deleted="is_deleted", updated="source_updated_at") -> DataFrame:
    """Tombstones of rows that were served and are no longer publishable: old fields, the later of both update times. A status without a time keeps the row's; a row without one has none."""
    off = status.where(F.col("publication_status") == "NOT_PUBLISHABLE").select(*key, F.col("status_updated_at").alias("__at"))
    later = F.when(F.col(updated).isNotNull(), F.greatest(updated, F.coalesce("__at", updated)))
    return previous.where(~F.col(deleted)).join(off, key).withColumns({deleted: F.lit(True), updated: later}).drop("__at")


def apply_snapshot(target: DataFrame | None, extract: DataFrame, run_at: Column, key: str = "id", full_refresh: bool = False) -> DataFrame:
    """Merge a raw snapshot: unique ids are required, ids that are missing from it are soft-deleted, insertion times stay."""
    twice = extract.groupBy(key).count().where("count > 1 OR " + key + " IS NULL")
    if not twice.isEmpty():
        raise ValueError("ids of a snapshot must be unique and not null")
    fresh = extract.withColumns({"_extracted_at": run_at, "_is_deleted": F.lit(False)})
    if target is None or full_refresh:
        return fresh.withColumn("_inserted_at", run_at)
    merged = fresh.join(target.select(key, "_inserted_at"), key, "left").withColumn("_inserted_at", F.coalesce("_inserted_at", run_at))
    gone = target.join(extract.select(key), key, "left_anti").withColumn("_is_deleted", F.lit(True))
    return merged.unionByName(gone, allowMissingColumns=True)


def due_for_reeval(df: DataFrame, valid_through: str, last_run: Column, as_of: Column, reviewed: DataFrame | None = None, key: list[str] | None = None) -> DataFrame:
    """Rows whose validity ended since the last run, or whose review changed."""
    due = df.where((F.col(valid_through) > last_run) & (F.col(valid_through) <= as_of))
    return due if reviewed is None else due.unionByName(df.join(reviewed.select(*key), key, "left_semi")).distinct()


def target_ready(target: DataFrame | None, cols: list[str]) -> bool:
    return target is not None and set(cols) <= set(target.columns)


def reconcile_schema(existing: StructType, desired: StructType) -> StructType:
    """Existing fields, relaxed where wanted, and new nullable ones; type changes and new required fields are refused."""
    have = {f.name: f for f in existing}
    out = StructType(list(existing.fields))
    for f in desired:
        if f.name in have and have[f.name].dataType != f.dataType:
            raise ValueError(f"{f.name} can't change from {have[f.name].dataType.simpleString()} to {f.dataType.simpleString()}")
        if f.name not in have and not f.nullable:
            raise ValueError(f"{f.name} is required and missing")
        if f.name not in have:
            out = out.add(f.name, f.dataType, True)
    wanted = {f.name: f.nullable for f in desired}
    result = StructType()
    for f in out:
        result = result.add(f.name, f.dataType, f.nullable or wanted.get(f.name, True))
    return result


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns of a reconciled schema, null where it has none."""
    return df.select(*(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Committed versions of a table's pointer, oldest first."""
    return [v for v in sorted(x for x in list_files(spark, f"{path}/_versions") if x.startswith("v=")) if "_SUCCESS" in list_files(spark, f"{path}/_versions/{v}")]


def current_parts(spark: SparkSession, path: str) -> list[tuple[int | None, str]]:
    """(bucket, snapshot) of what a table is made of; the bucket is null for a whole one, nothing is there before the first."""
    known = _versions(spark, path)
    return [(r.bucket, r.name) for r in spark.read.parquet(f"{path}/_versions/{known[-1]}").collect()] if known else []


def commit_parts(spark: SparkSession, path: str, parts: list[tuple[int | None, str]]) -> None:
    """Point a table to other parts: a new version next to the old ones, which readers find once it is complete.

    A version is claimed by a file that only one writer can create, so of two writers at once the second fails. The claim of a writer that
    was lost before its version was complete must be taken back (:func:`drop_claims`).
    """
    known = _versions(spark, path)
    number = int(known[-1][2:]) + 1 if known else 0
    if not create_file(spark, f"{path}/_claims/v={number:012d}"):
        raise ValueError(f"another writer has claimed version {number} of {path}")
    spark.createDataFrame(parts, "bucket int, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/_versions/v={number:012d}")


def drop_claims(spark: SparkSession, path: str) -> None:
    """Take back claims of writers that are known to be gone."""
    delete_folder(spark, f"{path}/_claims")


def save_snapshot(df: DataFrame, path: str, protected: bool = False, full_refresh: bool = False) -> str:
    """Write a new snapshot of a table and point to it. Protected tables refuse a full refresh."""
    if protected and full_refresh:
        raise ValueError("this table holds state and can't be rebuilt")
    name = uuid.uuid4().hex
    df.write.parquet(f"{path}/snapshot={name}")
    commit_parts(df.sparkSession, path, [(None, name)])
    return name


def read_parts(spark: SparkSession, path: str, parts: list[tuple[int | None, str]]) -> DataFrame:
    return spark.read.parquet(*(f"{path}/snapshot={name}" + ("" if bucket is None else f"/bucket={bucket}") for bucket, name in parts))


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path, current_parts(spark, path))


def expire_snapshots(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete what the last ``keep`` versions don't point to."""
    known = _versions(spark, path)
    names = {r.name for v in known[-keep:] for r in spark.read.parquet(f"{path}/_versions/{v}").collect()}
    for x in list_files(spark, path):
        if x.startswith("snapshot=") and x.removeprefix("snapshot=") not in names:
            delete_folder(spark, f"{path}/{x}")
    for v in known[:-keep]:
        delete_folder(spark, f"{path}/_versions/{v}")


def materialize(df: DataFrame, mode: str, name: str, key: list[str] | None = None) -> DataFrame:
    """As a view of that name, a table (a snapshot below that path), or an incremental table: rows of new keys are added to it, those of known keys replaced."""
    spark = df.sparkSession
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if mode not in ("table", "incremental"):
        raise ValueError(f"no such mode: {mode}")
    before = current_parts(spark, name)
    save_snapshot(upsert(read_parts(spark, name, before), df, key) if mode == "incremental" and before else df, name)
    return load_snapshot(spark, name)
