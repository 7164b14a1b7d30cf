"""The position of every row in a global order, found by all tasks together."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.workspace import materialize

_LOCAL = 1 << 33


def with_position(
    df: DataFrame, order: list[Column], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """``df`` with the 64-bit position of each row from 1 by ``order``, as ``row_number``
    over all rows would give it, but without a window that one task runs alone.

    Rows are dealt by range, sorted and written; a position is the number inside its
    range plus the sizes of the ranges before, which are as many as there are partitions.
    ``order`` should end in something unique: it fixes the order of ties, and lets a
    value that many rows share fall into several ranges. ``df`` is read twice, once for
    the ranges' bounds; pass a written table.
    """
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the number a row has within its partition, which Spark gives in the sorted order
    local = F.monotonically_increasing_id() % _LOCAL + 1
    placed = materialize(
        df.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumns({f"{name}_range": F.spark_partition_id(), name: local}),
        "positions",
    )
    sizes = [0] * (ranges + 1)
    for row in placed.groupBy(f"{name}_range").agg(F.count("*").alias("n")).collect():
        sizes[row[f"{name}_range"] + 1] = row["n"]
    before = F.array(*[F.lit(n).cast("bigint") for n in accumulate(sizes)])
    position = F.col(name) + F.get(before, F.col(f"{name}_range"))
    return placed.withColumn(name, position).drop(f"{name}_range")
