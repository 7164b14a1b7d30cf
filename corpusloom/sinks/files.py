"""Result files, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_counts(counts: DataFrame, path: str) -> None:
    """Key, tab, count; fails if ``path`` exists. Words are written as they are: a
    vertical tab at an end is part of one."""
    line = F.concat_ws("\t", "word", F.col("count").cast("string"))
    counts.select(line.alias("value")).write.mode("errorifexists").text(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t")
    return spark.read.schema("value STRING").text(path).select(
        F.get(parts, F.lit(0)).alias("word"), F.get(parts, F.lit(1)).cast("bigint").alias("count")
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated without a header; replaces ``path``."""
    df.write.mode("overwrite").csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """The ``line`` column in order; the part files put together are the report."""
    report.select("line").write.mode("overwrite").text(path)
