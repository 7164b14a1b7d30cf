"""Header metadata of books and its summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import headers


def book_metadata(books: DataFrame) -> DataFrame:
    """One row per book; a missing field is ''. The text itself is not kept."""
    text = F.col("text")
    return books.select(
        "file_name",
        headers.field(text, headers.TITLE).alias("title"),
        headers.field(text, headers.RELEASE_DATE).alias("release_date"),
        headers.field(text, headers.LANGUAGE).alias("language"),
        headers.field(text, headers.ENCODING).alias("encoding"),
    )


def dated_books(metadata: DataFrame) -> DataFrame:
    """Books whose release date holds a year, with it as ``release_year INT``."""
    year = headers.year_text(F.col("release_date"))
    return (
        metadata.withColumn("year_text", year)
        .filter(F.col("year_text") != "")
        .withColumn("release_year", F.col("year_text").try_cast("int"))
        .drop("year_text")
        .filter(F.col("release_year").isNotNull())
    )


def books_per_year(metadata: DataFrame) -> DataFrame:
    counts = dated_books(metadata).groupBy("release_year")
    return counts.agg(F.count("*").alias("book_count")).orderBy(F.desc("release_year"))


def books_per_language(metadata: DataFrame) -> DataFrame:
    """Most frequent language first, ties by name."""
    named = metadata.filter(F.col("language").isNotNull() & (F.col("language") != ""))
    counts = named.groupBy("language").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "language")


def top_language(metadata: DataFrame) -> DataFrame:
    return books_per_language(metadata).limit(1)


def titles(metadata: DataFrame) -> DataFrame:
    """``(title, title_length)`` of the books that have a title."""
    return metadata.filter(F.col("title").isNotNull() & (F.col("title") != "")).select(
        "title", F.length("title").alias("title_length")
    )


def average_title_length(metadata: DataFrame) -> DataFrame:
    """One row; NULL where no book has a title."""
    return titles(metadata).agg(F.avg("title_length").alias("avg_length"))


def title_statistics(metadata: DataFrame) -> DataFrame:
    """count, mean, stddev, min and max of the title and of its length, as text."""
    return titles(metadata).describe("title", "title_length")
