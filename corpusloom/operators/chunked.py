"""Header fields and term counts of books that are read in chunks, however long they are.

Positions are pairs of a chunk's begin and a place in its text, so the first one of a
book is a minimum over its chunks, and no row holds more than a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import headers
from corpusloom.functions import text as t
from corpusloom.functions.stop_words import ENGLISH
from corpusloom.operators.word_count import word_count
from corpusloom.sources.chunks import decoded, ranges, read_ranges

FIELDS = {
    "title": headers.TITLE,
    "release_date": headers.RELEASE_DATE,
    "language": headers.LANGUAGE,
    "encoding": headers.ENCODING,
}
MARKERS = (*t.START_MARKERS, *t.END_MARKERS)


def book_positions(chunks: DataFrame) -> DataFrame:
    """One row for each file: ``file_name``, the header fields, ``(start, place)`` of the
    first of each marker as ``marks``, and ``error`` for one that cannot be read."""
    texts = chunks.select(
        "file_name",
        "start",
        "error",
        F.length(decoded(F.col("content"))).alias("own"),
        decoded(F.concat("content", "after")).alias("text"),
    )

    def owned(place: Column, *more: Column) -> Column:
        # what begins behind the chunk belongs to the next one
        return F.when(place.between(1, F.col("own")), F.struct("start", place.alias("place"), *more))

    fields = [
        F.min(
            owned(
                F.regexp_instr("text", F.lit(pattern)),
                F.regexp_extract("text", pattern, 1).alias("value"),
            )
        ).alias(name)
        for name, pattern in FIELDS.items()
    ]
    marks = [F.min(owned(F.locate(m, F.col("text")))).alias(f"m{i}") for i, m in enumerate(MARKERS)]
    found = texts.groupBy("file_name").agg(*fields, *marks, F.max("error").alias("error"))
    return found.select(
        "file_name",
        *[F.coalesce(F.col(name)["value"], F.lit("")).alias(name) for name in FIELDS],
        F.array(*[f"m{i}" for i in range(len(MARKERS))]).alias("marks"),
        "error",
    )


def book_metadata(positions: DataFrame) -> DataFrame:
    """The header fields of the books that could be read."""
    return positions.filter("error is null").select("file_name", *FIELDS)


def failures(positions: DataFrame) -> DataFrame:
    """``(file_name, error)``."""
    return positions.filter("error is not null").select("file_name", "error")


def book_terms(
    listing: DataFrame,
    positions: DataFrame,
    folder: str,
    chunk_bytes: int,
    stop_words: Sequence[str] = ENGLISH,
) -> DataFrame:
    """``(file_name, term, tf)`` of the text between the markers.

    ``positions`` is a written table. The files in it are read once more; chunks outside
    the markers are not.
    """
    n = len(t.START_MARKERS)
    marks = [F.col("marks")[i] for i in range(len(MARKERS))]
    first, last = F.coalesce(*marks[:n]), F.coalesce(*marks[n:])
    bounds = positions.filter("error is null").select(
        "file_name",
        F.coalesce(first["start"], F.lit(0)).alias("from_start"),
        F.coalesce(first["place"], F.lit(1)).alias("from_place"),
        last["start"].alias("to_start"),
        last["place"].alias("to_place"),
    )
    # a chunk's nominal begin names it, so this holds before anything is read
    inside = (F.col("start") >= F.col("from_start")) & (
        F.col("to_start").isNull() | (F.col("start") <= F.col("to_start"))
    )
    wanted = ranges(listing, chunk_bytes).join(bounds, "file_name").filter(inside)
    text = decoded(F.col("content"))
    begin = F.when(F.col("start") == F.col("from_start"), F.col("from_place")).otherwise(1)
    end = F.when(F.col("start") == F.col("to_start"), F.col("to_place")).otherwise(F.length("text") + 1)
    content = F.substring(F.col("text"), begin, F.greatest(end - begin, F.lit(0)))
    chunks = read_ranges(wanted, folder, stop=True).withColumn("text", text)
    # a book's chunks are mostly in one task, which adds them up before the shuffle
    return (
        chunks.select("file_name", F.explode(t.letter_runs(content)).alias("term"))
        .filter(t.is_term(F.col("term"), stop_words))
        .groupBy("file_name", "term")
        .agg(F.count("*").alias("tf"))
    )


def chunk_word_count(chunks: DataFrame) -> DataFrame:
    """``(word, count)`` over all files that can be read."""
    return word_count(chunks.select(decoded(F.col("content")).alias("value")))
