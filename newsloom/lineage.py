"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    set_by_hand = context.getCheckpointDir()
    if set_by_hand:
        return set_by_hand.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="newsloom-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is used by nothing else."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/newsloom/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Compute the table once, write it to the shared folder with the writer's options and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` gave, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Meanwhile shuffle files are deleted at the end of each query; by default they wait for the driver's garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def clean(spark: SparkSession) -> None:
    """Delete the tables that this application has written to the shared folder, once nothing reads them any more."""
    folder = f"{shared_folder(spark)}/newsloom/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
