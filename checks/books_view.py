"""Books made from the given tables: documents with header fields put before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.tables import spread, table


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text", "lang"))


def books(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, text)``; some books lack a title, an author or a date."""
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    titles = part.filter(F.col("p_partkey").between(0, 99))  # one row a key
    number = F.col("doc_id")
    joined = documents(spark, folder).join(
        F.broadcast(titles), F.col("p_partkey") == number % 100
    )
    author = F.concat(
        _every(5, F.lit("by ")),
        F.lit("Writer "),
        (number % 97).cast("string"),
        _every(7, F.lit(" (1835-1910)")),
        _every(3, F.lit(",")),
    )
    date = F.concat(
        F.lit("June 9, "),
        (1970 + (number * 7) % 50).cast("string"),
        F.lit(" [EBook #"),
        number.cast("string"),
        F.lit("]"),
    )
    text = F.concat(
        _except(11, _field("Title", F.concat_ws(" ", "p_name", "p_brand"))),
        _except(13, _field("Author", author)),
        _except(17, _field("Release Date", date)),
        _field("Language", F.col("lang")),
        _field("Character set encoding", F.lit("UTF-8")),
        F.lit("*** START OF THIS EBOOK ***\n"),
        F.col("text"),
        F.lit("\n*** END OF THIS EBOOK ***\n"),
    )
    name = F.concat(number.cast("string"), F.lit(".txt"))
    return joined.select(name.alias("file_name"), text.alias("text"))


def _every(n: int, value: Column) -> Column:
    return F.when(F.col("doc_id") % n == 0, value).otherwise("")


def _except(n: int, value: Column) -> Column:
    return F.when(F.col("doc_id") % n == 0, F.lit("")).otherwise(value)


def _field(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), value, F.lit("\n"))
