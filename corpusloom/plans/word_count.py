"""Word count of text files, and its timing over input split sizes."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.word_count import sorted_word_count
from corpusloom.sinks.files import write_counts
from corpusloom.sources.files import lines
from corpusloom.workspace import new_path

# The split sizes of the experiment, in bytes. None leaves the
# session's own setting, 128 MB by default.
SPLIT_SIZES = (None, 16777216, 268435456, 4194304)


def run(spark: SparkSession, source: str, target: str, split_bytes: int | None = None) -> int:
    """Write the counts and return the milliseconds it took."""
    begin = time.perf_counter()
    write_counts(sorted_word_count(lines(spark, source, split_bytes)), target)
    return _milliseconds(begin)


def _milliseconds(begin: float) -> int:
    return round((time.perf_counter() - begin) * 1000)


def split_sweep(
    spark: SparkSession, source: str, sizes: Sequence[int | None] = SPLIT_SIZES
) -> DataFrame:
    """``(split_bytes, partitions, ms)``: the same count, written, timed for each size
    after one that is not."""
    run(spark, source, new_path(spark, "sweep"))
    measured = []
    for size in sizes:
        spent = run(spark, source, new_path(spark, "sweep"), size)
        measured.append((size, lines(spark, source, size).rdd.getNumPartitions(), spent))
    return spark.createDataFrame(measured, "split_bytes BIGINT, partitions INT, ms BIGINT")
