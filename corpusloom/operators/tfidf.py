"""TF-IDF weights of exact terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions.stop_words import ENGLISH
from corpusloom.operators.joins import lookup_join
from corpusloom.workspace import materialize


def content(books: DataFrame) -> DataFrame:
    """``(file_name, content)``; a book without text has no content."""
    text = F.coalesce("text", F.lit(""))
    return books.select("file_name", t.main_content(text).alias("content"))


def cleaned(books: DataFrame) -> DataFrame:
    """``(file_name, clean_text)``."""
    return content(books).select("file_name", t.clean_text(F.col("content")).alias("clean_text"))


def filtered_tokens(books: DataFrame, stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """``(file_name, filtered_tokens)``, in text order."""
    terms = t.content_terms(F.col("content"), stop_words)
    return content(books).select("file_name", terms.alias("filtered_tokens"))


def term_vectors(books: DataFrame, stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """``(file_name, terms)``: one row per book, its distinct terms with counts.

    A book is one row, so its terms are counted where the row is; the pairs of
    book and term, the largest table there is, cross no shuffle.
    """
    counted = t.term_counts(F.col("filtered_tokens"))
    return filtered_tokens(books, stop_words).select("file_name", counted.alias("terms"))


def term_frequency(vectors: DataFrame) -> DataFrame:
    """``(file_name, term, tf)``."""
    pairs = vectors.select("file_name", F.inline_outer("terms"))
    return pairs.filter(F.col("term").isNotNull())


def document_frequency(vectors: DataFrame) -> DataFrame:
    """``(term, df)``."""
    terms = vectors.select(F.explode_outer("terms.term").alias("term"))
    return (
        terms.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"))
    )


def inverse_document_frequency(df: DataFrame, books: int, min_df: int = 2) -> DataFrame:
    """``(term, df, idf)`` with idf ln((books + 1) / (df + 1)), 0 below ``min_df``."""
    idf = F.ln(F.lit(books + 1.0) / (F.col("df") + 1.0))
    return df.withColumn("idf", F.when(F.col("df") >= min_df, idf).otherwise(0.0))


def tfidf_weights(vectors: DataFrame, idf: DataFrame) -> DataFrame:
    """``(file_name, term, weight)``, zero weights left out."""
    lookup = idf.filter(F.col("idf") > 0)
    pairs = lookup_join(term_frequency(vectors), lookup, ["term"], "df")
    return pairs.select("file_name", "term", (F.col("tf") * F.col("idf")).alias("weight"))


def unit_weights(weights: DataFrame) -> DataFrame:
    """Weights over their book's Euclidean length. A zero vector has no rows.

    ``weights`` is read twice; pass a written table.
    """
    lengths = materialize(
        weights.groupBy("file_name").agg(
            F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"),
            F.count("*").alias("terms"),
        ),
        "lengths",
    )
    scaled = lookup_join(weights, lengths, ["file_name"], "terms")
    return scaled.select("file_name", "term", (F.col("weight") / F.col("length")).alias("weight"))
