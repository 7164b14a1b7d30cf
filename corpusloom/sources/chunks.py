"""Text files as chunks of bytes, each file with an outcome.

A folder is listed inside a task, so hidden and empty files are rows like any other, and
byte ranges are read where they are dealt to. A chunk runs from the first place at or
after its nominal begin where white space ends to the first such place at or after its
nominal end. Every byte has one owner that way, and no word, character or CRLF is cut.
What does not fit between two blanks stays one chunk.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.files import unix_newlines, valid_text
from corpusloom.workspace import materialize

RANGES = "file_name STRING, path STRING, bytes BIGINT, is_file BOOLEAN"
CHUNKS = "file_name STRING, start BIGINT, content BINARY, after BINARY, error STRING"

CHUNK_BYTES = 16 << 20
# Bytes of all ranges that a task reads about, and of content handed over at once.
TASK_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
# Ranges of fewer bytes on average are dealt by pieces of a file of this size.
PIECE_BYTES = 1 << 20
LISTED_ROWS = 10_000

# Bytes behind a chunk in which a marker may end, and the labels whose values are
# followed further, to the end of their line.
AFTER = 64
LABELS = ("Title:", "Author:", "Release Date:", "Language:", "Character set encoding:")


def file_listing(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """``(file_name, path, bytes, is_file)`` of everything directly in ``folder`` whose
    name ends in ``suffix``. One task lists, and the names go from there to the others.
    A link that leads nowhere is not listed. The folder must be in a store that pyarrow
    opens; for others there is :func:`corpusloom.sources.files.books`. A local folder is
    listed in pieces, of others pyarrow holds all names at once.
    """
    place = folder if ":" in folder else os.path.abspath(folder)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import batched

        from pyarrow import fs

        def local() -> Iterator[tuple[str, str, int, bool]]:
            with os.scandir(root) as entries:
                for entry in entries:
                    if entry.name.endswith(suffix):
                        try:
                            size = entry.stat().st_size
                        except FileNotFoundError:
                            continue
                        is_file = entry.is_file()
                        yield entry.name, os.path.join(root, entry.name), size if is_file else 0, is_file

        def other() -> Iterator[tuple[str, str, int, bool]]:
            for x in store.get_file_info(fs.FileSelector(root)):
                if x.base_name.endswith(suffix):
                    yield x.base_name, x.path, x.size or 0, x.type == fs.FileType.File

        for _ in batches:
            pass
        store, root = fs.FileSystem.from_uri(place)
        found = local() if isinstance(store, fs.LocalFileSystem) else other()
        kinds = {"file_name": pa.string(), "path": pa.string(), "bytes": pa.int64(), "is_file": pa.bool_()}
        for some in batched(found, LISTED_ROWS):
            columns = [pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, list(kinds))

    return spark.range(0, 1, 1, 1).mapInArrow(listed, RANGES)


def written_listing(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """:func:`file_listing`, listed once for all later steps and dealt over the cores."""
    listing = file_listing(spark, folder, suffix)
    return materialize(listing.repartition(spark.sparkContext.defaultParallelism, "path"), "listing")


def ranges(listing: DataFrame, chunk_bytes: int | None = CHUNK_BYTES) -> DataFrame:
    """The files cut into ranges of ``chunk_bytes``, or whole ones without it, with the
    nominal begin in ``start`` and the size in ``step``; at least one for each file."""
    step = F.lit(chunk_bytes).cast("bigint") if chunk_bytes else F.greatest("bytes", F.lit(1))
    cut = listing.withColumn("step", step)
    last = F.greatest(F.col("bytes") - 1, F.lit(0))
    return cut.withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.col("step"))))


def read_ranges(dealt: DataFrame, folder: str, stop: bool = False) -> DataFrame:
    """``(file_name, start, content, after, error)`` and any further columns of
    ``dealt``: the chunk that belongs to each range, or why its file cannot be read.

    A range without a chunk of its own has no row, unless it is a file's first. With
    ``stop`` a file that cannot be read stops the job.
    """
    place = folder if ":" in folder else os.path.abspath(folder)
    known = ("file_name", "path", "bytes", "is_file", "step", "start")
    further = [f for f in dealt.schema if f.name not in known]
    schema = CHUNKS + "".join(f", {f.name} {f.dataType.simpleString()}" for f in further)
    after_bytes, labels, held_bytes = AFTER, LABELS, BATCH_BYTES
    extra = [f.name for f in further]

    # self-contained, so that workers need not have this package
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(place)
        cut_at = re.compile(rb"[ \t\n\r\f](?=[^ \t\n\r\f\v])")
        value_end = re.compile(r":\s*\S[^\r\n]*[\r\n]")

        # the file read last, and where its last chunk ended: neighbours follow each other
        current, cuts = {}, {}

        def opened(path: str):
            if path not in current:
                shut()
                current[path] = store.open_input_file(path)
            return current[path]

        def shut() -> None:
            cuts.clear()
            while current:
                current.popitem()[1].close()

        def first_cut(file, at: int, size: int) -> int:
            if at <= 0 or at >= size:
                return min(max(at, 0), size)
            at -= 1
            while at < size:
                window = file.read_at(4096, at)
                found = cut_at.search(window)
                if found:
                    return at + found.end()
                # the last byte may be a blank before what comes next
                at += max(len(window) - 1, 1)
            return size

        def chunk(row: dict) -> tuple[bytes, bytes] | None:
            size = row["bytes"]
            if not row["is_file"]:
                raise OSError("not a file")
            file = opened(row["path"])
            beyond = row["start"] + row["step"]
            if row["start"] not in cuts:
                cuts[row["start"]] = first_cut(file, row["start"], size)
            begin = cuts[row["start"]]
            end = first_cut(file, beyond, size)
            cuts.clear()
            cuts[beyond] = end
            if begin >= end and row["start"]:
                return None
            content = file.read_at(end - begin, begin)
            after = file.read_at(after_bytes, end) if end < size else b""
            text = (content + after).decode("utf-8", "ignore") if end < size else ""
            last = max(text.rfind(label) for label in labels)
            while last >= 0 and end + len(after) < size and not value_end.search(text, last):
                after += file.read_at(4096, end + len(after))
                text = (content + after).decode("utf-8", "ignore")
            return content, after

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            names = ["file_name", "start", "content", "after", "error", *extra]
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.string(), *kinds_of]
            arrays = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        rows, size = [], 0
        for batch in batches:
            kinds_of = [batch.schema.field(n).type for n in extra]
            for row in batch.to_pylist():
                error = content = after = None
                try:
                    found = chunk(row)
                    if found is None:
                        continue
                    content, after = found
                except OSError as problem:
                    shut()
                    if stop:
                        raise
                    error = str(problem) or type(problem).__name__
                rows.append({**row, "content": content, "after": after, "error": error})
                size += len(content or b"")
                if size >= held_bytes or len(rows) >= 1000:
                    yield batch_of(rows)
                    rows, size = [], 0
        shut()
        if rows:
            yield batch_of(rows)

    return _dealt(dealt).mapInArrow(read, schema)


def _dealt(cut: DataFrame) -> DataFrame:
    """The ranges over tasks of about ``TASK_BYTES``, and over all cores at least. Small
    ones of the same piece of a file are neighbours in one task."""
    spark = cut.sparkSession
    size = F.sum(F.least("step", "bytes"))
    total, count = cut.agg(F.coalesce(size, F.lit(0)), F.count("*")).first()
    tasks = int(max(-(-total // TASK_BYTES), spark.sparkContext.defaultParallelism))
    if total >= count * PIECE_BYTES:
        return cut.repartition(tasks)
    piece = F.floor(F.col("start") / PIECE_BYTES)
    return cut.repartition(tasks, "path", piece).sortWithinPartitions("path", "start")


def file_chunks(
    spark: SparkSession,
    folder: str,
    suffix: str = ".txt",
    chunk_bytes: int | None = CHUNK_BYTES,
    stop: bool = False,
) -> DataFrame:
    return read_ranges(ranges(written_listing(spark, folder, suffix), chunk_bytes), folder, stop)


def decoded(content: Column) -> Column:
    """Text of bytes as UTF-8: bad bytes dropped, every line end LF."""
    return unix_newlines(valid_text(content.cast("string")))


def unread(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Names in the listing that ``seen``, a written table of all books read, lacks."""
    return listing.select("file_name").join(seen.select("file_name"), "file_name", "left_anti")


def book_outcomes(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """``(file_name, text, error)``: one row for each name, from one read. Hidden and
    empty files are books; what cannot be read has no text but an error."""
    whole = file_chunks(spark, folder, suffix, chunk_bytes=None)
    return whole.select("file_name", decoded(F.col("content")).alias("text"), "error")
