"""The books view as files, with the odd ones a folder can have: no bytes, CRLF, bytes that
are not UTF-8, hidden names, other suffixes, and folders named like books."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.books_view import books
from corpusloom.operators import chunked
from corpusloom.sources import chunks
from corpusloom.sources.files import session_with
from corpusloom.workspace import materialize, new_path

# Small, so that most books are several chunks.
CHUNK_BYTES = 1000
# Books that a task which writes files holds at once.
BATCH_ROWS = 500


def write_books(spark: SparkSession, folder: str) -> str:
    """Write the view under a new folder and return its path."""
    target = new_path(spark, "book-files")
    if ":" not in target:
        target = f"file://{target}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root, recursive=True)
        for batch in batches:
            names = []
            for value in zip(*batch.columns, strict=True):
                name, text = (v.as_py() for v in value)
                number, data = int(name.removesuffix(".txt")), text.encode()
                if number % 19 == 3:
                    data = b""
                if number % 19 == 4:
                    data = data.replace(b"\n", b"\r\n")
                if number % 19 == 5:
                    data = data.replace(b"e", b"e\xff")
                hidden = "_" if number % 23 == 1 else "." if number % 23 == 2 else ""
                if number % 29 == 7:
                    store.create_dir(f"{root}/{number}-folder.txt")
                    with store.open_output_stream(f"{root}/{number}.md") as file:
                        file.write(b"Title: no book\n")
                with store.open_output_stream(f"{root}/{hidden}{name}") as file:
                    file.write(data)
                names.append(name)
            yield pa.RecordBatch.from_pydict({"file_name": pa.array(names, pa.string())})

    # what a task holds at once, in a session of its own
    session = session_with(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)})
    books(session, folder).mapInArrow(write, "file_name STRING").count()
    return target


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    found = chunks.book_outcomes(spark, write_books(spark, folder))
    return found.select("file_name", "text", F.col("error").isNotNull().alias("failed"))


def _positions(spark: SparkSession, target: str, listing: DataFrame | None = None) -> DataFrame:
    listing = listing or chunks.written_listing(spark, target)
    read = chunks.read_ranges(chunks.ranges(listing, CHUNK_BYTES), target)
    return materialize(chunked.book_positions(read), "book-positions")


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    return chunked.book_metadata(_positions(spark, write_books(spark, folder)))


def failures(spark: SparkSession, folder: str) -> DataFrame:
    return chunked.failures(_positions(spark, write_books(spark, folder))).select("file_name")


def terms(spark: SparkSession, folder: str) -> DataFrame:
    target = write_books(spark, folder)
    listing = chunks.written_listing(spark, target)
    positions = _positions(spark, target, listing)
    return chunked.book_terms(listing, positions, target, CHUNK_BYTES)


def words(spark: SparkSession, folder: str) -> DataFrame:
    target = write_books(spark, folder)
    return chunked.chunk_word_count(chunks.file_chunks(spark, target, chunk_bytes=CHUNK_BYTES))
