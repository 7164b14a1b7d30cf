"""Tables written once and read by several later steps.

They live in the shared folder the cluster names in ``spark.checkpoint.dir``,
so that a lost executor costs a re-read and not a second pass over the corpus.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/corpusloom-{label}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, label: str, batch_rows: int | None = None, group_rows: int | None = None
) -> DataFrame:
    """Write ``df`` and return the written table.

    Compressed for size: at scale it is copied over the network more often than
    it is computed.

    Large rows would fill a task's memory, where Spark keeps to a number of rows: Python
    functions of ``df`` get at most ``batch_rows`` at once, and whoever writes or reads the
    table holds ``group_rows`` of it.
    """
    path = new_path(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    with _arrow_batches(df.sparkSession, batch_rows):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _arrow_batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Until the end, jobs of this session hand at most ``rows`` rows to Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    # a lower setting is kept; 0 and less set no limit
    if not rows or 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)
