"""Word counts over lines or whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import words


def word_count(texts: DataFrame, column: str = "value") -> DataFrame:
    """``(word, count)``. Each task adds up its own words before the shuffle,
    so a word that makes up most of the corpus costs one row per task."""
    return (
        texts.select(F.explode(words(F.col(column))).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("count"))
    )


def sorted_word_count(texts: DataFrame, column: str = "value") -> DataFrame:
    """Word counts in byte order of the word."""
    return word_count(texts, column).orderBy("word")
