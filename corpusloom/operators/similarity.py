"""Cosine similarity of one book to all others, and its ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.stop_words import ENGLISH
from corpusloom.operators import tfidf
from corpusloom.operators.joins import lookup_join
from corpusloom.workspace import materialize

# Scores closer than this many decimals count as equal and rank by name. Sums
# of doubles differ in their last bits from run to run.
TIE_DECIMALS = 10


def target_book(books: DataFrame, wanted: str) -> DataFrame:
    """One row ``(wanted, target)``: the wanted name, or the first where absent."""
    named = F.max(F.when(F.col("file_name") == wanted, F.col("file_name")))
    return books.agg(
        F.lit(wanted).alias("wanted"),
        F.coalesce(named, F.min("file_name")).alias("target"),
    )


def exact_similarity(vectors: DataFrame, target: str, min_df: int = 2) -> DataFrame:
    """``(file_name, similarity)`` of every other book, over exact terms.

    ``vectors`` is a written :func:`tfidf.term_vectors` table. It is read for
    the term weights and again for the scores; only terms of positive weight
    take part, and a book that shares none with the target scores 0.
    """
    target_terms = tfidf.term_frequency(vectors.filter(F.col("file_name") == target)).select(
        "term", F.col("tf").alias("target_tf")
    )
    idf = tfidf.inverse_document_frequency(
        tfidf.document_frequency(vectors), vectors.count(), min_df
    )
    lookup = materialize(
        idf.filter(F.col("idf") > 0)
        .join(target_terms, "term", "left")
        .select(
            "term",
            "df",
            "idf",
            (F.coalesce("target_tf", F.lit(0)) * F.col("idf")).alias("target_weight"),
        ),
        "term-weights",
    )
    squares = F.sum(F.col("target_weight") * F.col("target_weight"))
    target_length = lookup.agg(F.coalesce(F.sqrt(squares), F.lit(0.0))).first()[0]

    weighted = lookup_join(tfidf.term_frequency(vectors), lookup, ["term"], "df")
    weight = F.col("tf") * F.col("idf")
    parts = weighted.select(
        "file_name",
        (weight * weight).alias("square"),
        (weight * F.col("target_weight")).alias("product"),
    )
    every_book = vectors.select(
        "file_name", F.lit(0.0).alias("square"), F.lit(0.0).alias("product")
    )
    sums = (
        parts.unionByName(every_book)
        .filter(F.col("file_name") != target)
        .groupBy("file_name")
        .agg(F.sum("square").alias("square"), F.sum("product").alias("product"))
    )
    lengths = F.sqrt("square") * target_length
    cosine = F.when(lengths > 0, F.col("product") / lengths).otherwise(0.0)
    return sums.select("file_name", cosine.alias("similarity"))


def hashed_vectors(
    books: DataFrame,
    buckets: int = 65536,
    min_df: int = 2,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """``(file_name, norm_features)``: unit TF-IDF vectors over hashed terms."""
    hashing = HashingTF(inputCol="filtered_tokens", outputCol="tf_features", numFeatures=buckets)
    counted = materialize(
        hashing.transform(tfidf.filtered_tokens(books, stop_words)).select(
            "file_name", "tf_features"
        ),
        "hashed-counts",
    )
    if counted.isEmpty():  # there is nothing to fit
        return counted.withColumnRenamed("tf_features", "norm_features")
    idf = IDF(inputCol="tf_features", outputCol="tfidf_features", minDocFreq=min_df)
    weighted = idf.fit(counted).transform(counted)
    unit = Normalizer(inputCol="tfidf_features", outputCol="norm_features", p=2.0)
    return unit.transform(weighted).select("file_name", "norm_features")


def vector_similarity(vectors: DataFrame, target: str) -> DataFrame:
    """``(file_name, similarity)``: dot product of unit vectors with the target's.

    The target's entries are broadcast; there are at most as many as a vector
    has dimensions. Vectors stay sparse.
    """
    entries = vector_entries(vectors)
    of_target = entries.filter((F.col("file_name") == target) & (F.col("weight") != 0)).select(
        "bucket", F.col("weight").alias("target_weight")
    )
    product = (F.col("weight") * F.col("target_weight")).alias("product")
    products = entries.join(F.broadcast(of_target), "bucket").select("file_name", product)
    # a book that shares no bucket has this row only
    none = vectors.select("file_name", F.lit(0.0).alias("product"))
    others = products.unionByName(none).filter(F.col("file_name") != target)
    return others.groupBy("file_name").agg(F.sum("product").alias("similarity"))


def vector_entries(vectors: DataFrame) -> DataFrame:
    """``(file_name, bucket, weight)`` of sparse vectors, one NULL entry for an
    empty one."""
    parts = F.unwrap_udt("norm_features")
    entries = F.arrays_zip(parts["indices"].alias("bucket"), parts["values"].alias("weight"))
    return vectors.select("file_name", F.inline_outer(entries))


def by_similarity() -> list[Column]:
    return [F.desc(F.round("similarity", TIE_DECIMALS)), F.asc("file_name")]


def ranked(similarities: DataFrame) -> DataFrame:
    """All books, most similar first, ties by name."""
    return similarities.orderBy(*by_similarity())


def top_similar(similarities: DataFrame, n: int = 5) -> DataFrame:
    """``(rank, file_name, similarity)`` of the first ``n``."""
    # the window sees the n rows that are left, not the corpus
    place = F.row_number().over(Window.orderBy(*by_similarity()))
    return ranked(similarities).limit(n).select(
        place.alias("rank"), "file_name", "similarity"
    )


def report(similarities: DataFrame, target: str, n: int = 5) -> DataFrame:
    """``(section, line)``: the top ``n``, then every score, in reading order.

    Sorted by range over the executors, so the whole list passes no single task.
    """
    spark = similarities.sparkSession
    score = F.format_string("%.6f", "similarity")
    best = top_similar(similarities, n).select(
        F.lit(2).alias("section"),
        "rank",
        F.lit(0.0).alias("order"),
        "file_name",
        F.concat(F.col("rank"), F.lit(". "), "file_name", F.lit(" - similarity: "), score).alias("line"),
    )
    every = similarities.select(
        F.lit(4).alias("section"),
        F.lit(0).alias("rank"),
        (-F.round("similarity", TIE_DECIMALS)).alias("order"),
        "file_name",
        F.concat("file_name", F.lit(": "), score).alias("line"),
    )
    # The headings and rules of the report.
    rule = "-" * 50
    headings = spark.createDataFrame(
        [
            (1, 0, 0.0, "", f"Top {n} books similar to {target}:"),
            (1, 1, 0.0, "", rule),
            (3, 0, 0.0, "", ""),
            (3, 1, 0.0, "", ""),
            (3, 2, 0.0, "", "All similarity scores:"),
            (3, 3, 0.0, "", rule),
        ],
        every.schema,
    )
    lines = headings.unionByName(best).unionByName(every)
    return lines.orderBy("section", "rank", "order", "file_name")
