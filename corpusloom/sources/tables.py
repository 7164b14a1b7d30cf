"""Books and lines that already sit in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out where the input has fewer splits than there are cores.

    A file of one row group is read by one task, however long its texts are.
    An input with enough splits is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
