"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a local folder under a local master (tests); on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: intermediate tables need a folder that driver and executors share")
        found = os.environ.get("LOOMLINE_LOCAL_SHARED") or tempfile.mkdtemp(prefix="loomline-")
        os.environ["LOOMLINE_LOCAL_SHARED"] = found
        found = f"file://{found}"
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for a table that goes when the driver ends, or before that by drop()."""
    path = f"{shared_dir(spark)}/loomline/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def reread(spark: SparkSession, path: str, schema) -> DataFrame:
    df = spark.read.schema(schema).parquet(path)
    df.written_path = path
    return df


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """df, written once as Parquet to the shared folder and read again; by: a column whose values get folders of their own."""
    path = new_path(df.sparkSession, name)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return reread(df.sparkSession, path, df.schema)


def drop(*tables: DataFrame) -> None:
    """Deletes written() tables now. For tables whose every reader has itself been written."""
    for df in tables:
        if path := getattr(df, "written_path", None):
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path through Spark's file systems, or as a local one after the session has ended."""
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc is None:
        if path.startswith("file://"):
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        return
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
