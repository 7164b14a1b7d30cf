"""From documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and
read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import documents
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.jaccard_join import near_duplicates
from corpusloom.llm.packing import pack
from corpusloom.llm.quality import quality_verdicts
from corpusloom.llm.secret_scan import find_secrets, redacted
from corpusloom.workspace import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a quality rule rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    verdicts = quality_verdicts(docs, labels)
    return _only(docs, verdicts.filter("kept").select("doc_id"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest identifier."""
    found = exact_duplicates(docs, keep="largest")
    return _only(docs, found.filter("kept").select("doc_id"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the smallest identifier."""
    found = near_duplicates(docs)
    return _only(docs, found.filter("component_id <=> doc_id").select("doc_id"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark and ``n_chars`` counted anew."""
    # one struct, so that no column clashes with those of the result
    found = find_secrets(docs.select("text", F.struct(*_columns(docs)).alias("document")))
    changed = F.size("spans") > 0
    text = F.when(changed, redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    # in a step of its own: beside an alias "text" the text below would be the new one
    cleaned = found.select("document", changed.alias("changed"), text.alias("text"))
    own = {c: F.col("document").getField(c) for c in docs.columns}
    own["text"] = F.col("text")
    if "n_chars" in own:
        count = F.when(F.col("changed"), F.length("text")).otherwise(own["n_chars"])
        own["n_chars"] = count.cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*[column.alias(name) for name, column in own.items()])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return pack(docs).places()


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

# Least squares, cutoffs and components are not expressed in SQL; a test compares the rows
# of every stage with a brute-force version, with labels that prove a cutoff.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> list[Column]:
    return [docs[c] for c in docs.columns]


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents in ``ids``; of rows that repeat an identifier all or none."""
    kept = ids.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
