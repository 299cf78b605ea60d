"""Landing files, completed-run gates, seeds and incremental scans."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from factline.operators.relational import hashed
from factline.sources.storage import list_files, write_shared


def run_path(path: str, run_id: str) -> str:
    return f"{path}/run={run_id}"


def write_landing(df: DataFrame, path: str, run_id: str, chunk_rows: int = 5000) -> None:
    """JSON lines of one run, at most ``chunk_rows`` a file, refused if the run is there already."""
    df.write.option("maxRecordsPerFile", chunk_rows).option("ignoreNullFields", "false").json(run_path(path, run_id))


def write_keys(df: DataFrame, path: str, run_id: str, key: str, chunk_rows: int = 5000) -> None:
    """The list of a run's keys, beside its rows: what tells a row that is gone from one that wasn't extracted."""
    df.select(key).write.option("maxRecordsPerFile", chunk_rows).json(f"{path}/keys/run={run_id}")


def read_keys(spark: SparkSession, path: str, run_id: str, schema: StructType | str) -> DataFrame:
    return read_landing(spark, f"{path}/keys", run_id, schema)


#: The columns of an envelope besides its payload, with their types.
LINEAGE = "contract_version string, stage_run_id string, source_step string, source_run_id string, source_artifact string, source_artifact_sha256 string, source_record_index long"


def read_envelopes(spark: SparkSession, path: str, payload: StructType | str | None = None, more: str = "") -> DataFrame:
    """Envelopes of a folder of JSON lines: lineage, ``payload`` as JSON text, and ``more`` optional columns. With a type of the payload its fields follow, null where they can't be read."""
    rows = spark.read.schema(f"{LINEAGE}, payload string" + (f", {more}" if more else "")).option("mode", "FAILFAST").json(path)
    return rows if payload is None else rows.withColumn("__p", F.from_json("payload", payload)).select(*rows.columns, "__p.*")


def is_complete(spark: SparkSession, path: str, run_id: str) -> bool:
    """Whether a run has its marker and data; a partial one is refused."""
    names = list_files(spark, run_path(path, run_id))
    data = any(n.startswith("part-") for n in names)
    if names and not ("_SUCCESS" in names and data):
        raise ValueError(f"run {run_id} is partial")
    return bool(names)


def read_landing(spark: SparkSession, path: str, run_id: str, schema: StructType | str) -> DataFrame:
    """Rows of one complete run under a declared schema; anything else fails."""
    if not is_complete(spark, path, run_id):
        raise ValueError(f"run {run_id} has no files")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(run_path(path, run_id))


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A small reviewed CSV with a header; the text NA stays text."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").option("mode", "FAILFAST").csv(path)


def read_new(source: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Rows of a source beyond the target's highest landing mark."""
    mark = target.agg(F.max(col)).first()[0]
    return source if mark is None else source.where(F.col(col) > F.lit(mark))


def table_path(root: str, env: str, layer: str, name: str) -> str:
    """Production tables live in their layer, others below the environment's name."""
    return f"{root}/{layer}/{name}" if env == "prod" else f"{root}/{env}_{layer}/{name}"


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files (file, line, text), numbered from 1 in each file.

    A task reads a block of a file, in order: a line's number is that of the block's earlier lines, from the order in which they were read, and of
    the lines of the file's earlier blocks, a sum over a row for each block. The blocks' counts are taken in one pass and written.
    """
    return _numbered(spark, path)[0]


def _numbered(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The lines of :func:`read_numbered`, and the blocks that they stand in, with the first line of each (``__head``)."""
    at = F.monotonically_increasing_id().alias("__at")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), at)
    blocks = lines.groupBy("file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"), F.min_by("value", "__at").alias("__head"))
    blocks = write_shared(blocks, "blocks")
    earlier = F.coalesce(F.sum("__n").over(Window.partitionBy("file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("file", "__block", "__first", earlier.alias("__earlier"))
    numbered = lines.join(hashed(starts), ["file", "__block"]).select("file", (F.col("__earlier") + F.col("__at") - F.col("__first") + 1).alias("line"), F.col("value").alias("text"))
    return numbered, blocks


def read_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files whose first line names the columns, as text, with the ``_file`` and ``_line`` they stand in. A value may not hold a line feed; all files must have the same columns, and missing values are null."""
    lines, blocks = _numbered(spark, path)
    first = blocks.groupBy("file").agg(F.min_by("__head", "__block").alias("text"))
    heads = [r.text for r in first.select("text").distinct().limit(2).collect()]
    if len(heads) != 1:
        raise ValueError(f"files of {path} have {len(heads) or 'no'} kinds of columns")
    names = [x.strip() for x in next(csv.reader([heads[0]]))]
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    # A line is parsed by a generator, once: what filters ask of its columns isn't turned into parsing it for each of them.
    parsed = F.inline(F.array(F.from_csv("text", schema.simpleString()[7:-1].replace(":", " "))))
    rows = lines.where("line > 1").select(F.col("file").alias("_file"), F.col("line").alias("_line"), parsed)
    return rows.select("_file", "_line", *(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n))


def validate_contract(df: DataFrame, contract: dict[str, tuple[str, bool]], fail_on_reject: bool = True, at: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows of text columns by {name: (type, required)}; blank rows are dropped, errors named in ``_errors``.

    ``at`` are columns that say where a row stands: both results keep them, and a refusal names the first rejected row by them.
    """
    missing = set(contract) - set(df.columns)
    if missing:
        raise ValueError(f"columns are missing: {sorted(missing)}")
    blank = {c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in contract}
    rows = df.select(*at, *(v.alias(c) for c, v in blank.items())).dropna("all", subset=list(contract))
    typed, errors = {}, []
    for c, (kind, required) in contract.items():
        text = F.col(c)
        if kind == "boolean":
            typed[c] = F.when(F.lower(text).isin("true", "1"), True).when(F.lower(text).isin("false", "0"), False)
        else:
            typed[c] = text.try_cast(kind)
        errors.append(F.when(text.isNull() & F.lit(required), f"{c} is required").when(text.isNotNull() & typed[c].isNull(), f"{c} is no {kind}"))
    checked = rows.select(*at, F.array_compact(F.array(*errors)).alias("_errors"), F.struct(*contract).alias("_raw"), *(v.alias(c) for c, v in typed.items()))
    rejected = checked.where("size(_errors) > 0").select(*at, "_errors", "_raw.*")
    if fail_on_reject and (first := (rejected.orderBy(*at) if at else rejected).head(1)):
        place = ", ".join(f"{c} {first[0][c]}" for c in at)
        raise ValueError(f"a row breaks its contract{' at ' + place if at else ''}: {first[0]['_errors']}")
    return checked.where("size(_errors) = 0").select(*at, *contract), rejected
