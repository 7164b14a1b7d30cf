"""What the operators of this folder share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the white space between words.
WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` only, so that no other column can clash; a null text is ''."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def exact_ids(docs: DataFrame) -> DataFrame:
    """``doc_id`` as text on its way to pandas, which makes doubles of whole numbers that
    share a batch with a null; :func:`whole_ids` turns it back."""
    return docs.withColumn("doc_id", F.col("doc_id").cast("string"))


def whole_ids(ids: pd.Series) -> pd.api.extensions.ExtensionArray:
    return pd.array([None if pd.isna(i) else int(i) for i in ids], "Int64")


def words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once; a plain reference would be
    copied into every lambda of ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_by_share(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    fact_rows: str,
    total: int,
    parts: int = 1000,
) -> DataFrame:
    """Left join of ``facts`` to ``lookup``, which has one row per key and in
    ``fact_rows`` the number of facts of that key, ``total`` being that of all facts.

    Keys with more than 1/``parts`` of all facts are fewer than ``parts``, so they
    are broadcast, and their facts stay where they are. All other keys join by
    shuffle, none of them larger than that share.
    """
    share = max(total // parts, 1)
    frequent = F.broadcast(lookup.filter(F.col(fact_rows) > share))
    rest = lookup.filter(F.col(fact_rows) <= share)
    of_rest = facts.join(frequent.select(keys), keys, "left_anti").join(rest, keys, "left")
    return facts.join(frequent, keys).unionByName(of_rest)


def ship_package(spark: SparkSession) -> None:
    """Let Spark send this package to its Python workers, which may not have it."""
    context = spark.sparkContext
    if getattr(context, "_corpusloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context._corpusloom_shipped = True
