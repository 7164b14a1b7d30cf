"""Exact duplicates by a tree merge of sorted digest runs.

Rows start in leaves that have nothing to do with their text. In every round a
node gathers the sorted runs of 16 nodes, one hexadecimal digit of the digest
taking the place of one digit of the leaf, and merges equal entries into one that
holds the count and the smallest and largest identifier. Entries are equal only
if digest, byte length and an independent checksum agree, which is verified at
every level. After the last round a node holds one slice of the digests of the
whole table, so no node ever sees all of them, and copies, however many, reach a
node as one entry from each of at most 16 others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import id_and_text, join_by_share, shuffle_partitions
from corpusloom.workspace import materialize

ROUNDS = 3
RUN_KEY = ["digest", "n_bytes", "checksum"]


def digest_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, n_bytes, checksum)``, the only pass over the texts."""
    text = F.col("text")
    return id_and_text(docs).select(
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.xxhash64(text).alias("checksum"),
    )


def merge_runs(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row for each text: the run key, ``group_size``, ``smallest``, ``largest``."""
    slots = shuffle_partitions(rows.sparkSession)
    leaf = F.lower(F.lpad(F.hex(F.xxhash64("doc_id")), 16, "0"))
    runs = rows.select(
        *RUN_KEY,
        F.lit(1).cast("bigint").alias("group_size"),
        F.col("doc_id").alias("smallest"),
        F.col("doc_id").alias("largest"),
        F.substring(leaf, 1, rounds).alias("node"),
    )
    runs = _merge(runs)
    for level in range(1, rounds + 1):
        own = F.substring(F.lower(F.hex("digest")), 1, level)
        node = F.concat(own, F.expr(f"substring(node, {level + 1})"))
        moved = runs.withColumn("node", node).repartition(slots, "node")
        runs = _merge(moved)
    return runs.drop("node")


def _merge(runs: DataFrame) -> DataFrame:
    """Equal entries of a node become one.

    Structs do not fit into the buffer of a hash aggregate, so Spark sorts the runs and
    merges neighbours, before the rows move and again where they meet.
    """
    merged = runs.groupBy("node", *RUN_KEY).agg(
        F.sum("group_size").alias("group_size"),
        F.min(_named("smallest")).alias("least"),
        F.max(_named("largest")).alias("most"),
    )
    return merged.select(
        "node", *RUN_KEY, "group_size", F.col("least.smallest"), F.col("most.largest")
    )


def _named(column: str) -> Column:
    # null without an identifier, so that it is not the smallest
    return F.when(F.col(column).isNotNull(), F.struct(column))


def exact_duplicates(docs: DataFrame, keep: str = "smallest", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row for each row.

    ``keep`` says which identifier of equal texts stays, 'smallest' or 'largest'.
    A null text is the empty text, and empty texts are equal to each other. A row
    without an identifier is counted, and stays only where its whole group has
    none. Rows that repeat an identifier and its text are one document: they count
    one by one and share one verdict. An empty table gives no rows.
    """
    rows = materialize(digest_rows(docs), "digests")
    groups = materialize(merge_runs(rows, rounds).filter(F.col("group_size") > 1), "copies")
    lookup = groups.select(*RUN_KEY, "group_size", F.col(keep).alias("keep_id"))
    found = join_by_share(rows, lookup, RUN_KEY, "group_size", rows.count())
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        keep_id.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
