"""Reading Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, *, spread_by: str | None = None) -> DataFrame:
    """A Parquet table; with ``spread_by``, small input is spread over all cores.

    A file with one row group is read by one task. If the scan has fewer splits than the
    cluster has cores, the table holds at most that many splits' worth of data and is cheap to
    shuffle once by its key; larger tables are left as they are.
    """
    table = spark.read.parquet(path)
    if spread_by is None:
        return table
    cores = spark.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores, spread_by)
