"""The operators of this folder as queries, and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import (
    alignment,
    class_ngrams,
    exact_dedup,
    jaccard_join,
    line_templates,
    packing,
    piece_bpe,
    quality,
    secret_scan,
    suffix_dedup,
    token_files,
    treap_search,
    tree_bpe,
)
from corpusloom.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return class_ngrams.class_bigram_scores(documents(spark, folder))


def op2_nnls_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder)).places()


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality.quality_verdicts(documents(spark, folder), labels)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = secret_scan.find_secrets(docs)

    def count(rank: int):
        spans = F.filter("base", lambda s: s["rank"] == rank)
        return F.size(spans).cast("bigint")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op5_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return tree_bpe.encode_documents(documents(spark, folder), digest=True)


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(documents(spark, folder)).documents()


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder), keep="largest")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(documents(spark, folder))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


def op9_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    found = line_templates.line_dedup(documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, folder))


def op11_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return piece_bpe.encode_documents(documents(spark, folder), digest=True)


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(documents(spark, folder)).documents()


def op13_treap_search(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return treap_search.build_index(documents(spark, folder)).search(items)


def all_queries() -> dict[str, Query]:
    return {
        "op1_class_ngrams": op1_class_ngrams,
        "op2_nnls_packing": op2_nnls_packing,
        "op3_quality_rules": op3_quality_rules,
        "op4_secret_scan": op4_secret_scan,
        "op5_tree_bpe": op5_tree_bpe,
        "op6_token_files": op6_token_files,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_line_templates": op9_line_templates,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_piece_bpe": op11_piece_bpe,
        "op12_alignment": op12_alignment,
        "op13_treap_search": op13_treap_search,
        "pipeline": corpus_pipeline.run,
    }


def all_oracles() -> dict[str, str]:
    return {
        "op7_exact_dedup": """
            with t as (select doc_id, coalesce(text, '') as text from documents),
            g as (select *, max(doc_id) over (partition by text) as keep_id,
                  count(*) over (partition by text) as group_size from t)
            select doc_id, keep_id, group_size, doc_id = keep_id as kept,
                   sha256(text) as text_sha256
            from g
        """,
    }
