"""Where intermediate tables are written so that every executor and the driver can read them again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``.

    The setting is the cluster's. Only a session in local mode without it, as in tests, gets a folder of
    its own; any other session without it is refused, as a machine-local folder would lose tables.
    """
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if not base:
        if not (spark.sparkContext.master or "").startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="factline-")
        spark.conf.set(_SETTING, base)
    return f"{base.rstrip('/')}/factline-{spark.sparkContext.applicationId}"


def write_shared(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder of any file system; none if there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(at)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_table(df: DataFrame) -> None:
    """Delete a table that :func:`write_shared` returned and that nothing reads any more."""
    own = shared_dir(df.sparkSession)
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if own.rsplit("/", 1)[-1] not in folder:
            raise ValueError(f"{folder} isn't a table of this application")
        delete_folder(df.sparkSession, folder)


def release_shared(spark: SparkSession) -> None:
    """Delete all that this application wrote with :func:`write_shared`; frames that read it are void afterwards."""
    delete_folder(spark, shared_dir(spark))
