"""Chunks of files against whole files: every byte once, nothing cut, outcomes by name."""

import random

import pytest
from pyspark.sql import functions as F

from checks import book_files
from corpusloom.operators import chunked, metadata, tfidf
from corpusloom.operators.word_count import word_count
from corpusloom.sources import chunks
from corpusloom.workspace import materialize


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(4)
    bits = [b"word", b" ", b"\n", b"\r\n", b"\r", b"\t", "é漢".encode(), b"\xff", b"\x0b", b"Title: a b", b"*** START OF"]
    for i in range(6):
        (tmp_path / f"{i}.txt").write_bytes(b"".join(rng.choice(bits) for _ in range(rng.randint(0, 400))))
    (tmp_path / "_hidden.txt").write_bytes(b"Title: Hidden\n")
    (tmp_path / ".dot.txt").write_bytes(b"x")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "solid.txt").write_bytes(b"x" * 10_000)
    (tmp_path / "name with + %41.txt").write_bytes(b"a")
    (tmp_path / "other.md").write_bytes(b"no book")
    (tmp_path / "folder.txt").mkdir()
    return tmp_path


def _bytes(folder):
    return {p.name: p.read_bytes() for p in folder.iterdir() if p.name.endswith(".txt") and p.is_file()}


@pytest.mark.parametrize("size", [1, 7, 64, 1000, None])
def test_chunks_hold_every_byte_once(spark, folder, size):
    rows = chunks.file_chunks(spark, str(folder), chunk_bytes=size).collect()
    found = {}
    for row in sorted(rows, key=lambda r: r["start"]):
        if row["error"] is None:
            found.setdefault(row["file_name"], []).append(bytes(row["content"]))
    assert {name: b"".join(parts) for name, parts in found.items()} == _bytes(folder)
    assert {r["file_name"] for r in rows if r["error"]} == {"folder.txt"}
    for parts in found.values():
        for left, right in zip(parts, parts[1:], strict=False):
            assert left[-1:] in b" \t\n\r\f" and right[:1] not in b" \t\n\r\f\v"
    assert len(found["solid.txt"]) == 1


def test_outcomes(spark, folder):
    rows = {r["file_name"]: r for r in chunks.book_outcomes(spark, str(folder)).collect()}
    assert set(rows) == {*_bytes(folder), "folder.txt"}
    for name, data in _bytes(folder).items():
        text = data.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")
        assert (rows[name]["text"], rows[name]["error"]) == (text, None)
    assert rows["folder.txt"]["text"] is None and rows["folder.txt"]["error"]


def test_files_gone_since_the_listing(spark, folder):
    gone = spark.createDataFrame([("gone.txt", f"{folder}/gone.txt", 2500, True)], chunks.RANGES)
    listing = chunks.file_listing(spark, str(folder)).union(gone)
    read = chunks.read_ranges(chunks.ranges(listing, 1000), str(folder))
    failed = chunked.failures(chunked.book_positions(read))
    assert {r["file_name"] for r in failed.collect()} == {"folder.txt", "gone.txt"}


def test_unread_names(spark, folder):
    listing = chunks.file_listing(spark, str(folder))
    seen = spark.createDataFrame([("0.txt",), ("_hidden.txt",)], "file_name STRING")
    left = {r["file_name"] for r in chunks.unread(listing, seen).collect()}
    assert left == {*_bytes(folder), "folder.txt"} - {"0.txt", "_hidden.txt"}


def test_stop(spark, folder):
    with pytest.raises(Exception, match="not a file"):
        chunks.file_chunks(spark, str(folder), stop=True).collect()


def test_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert chunks.book_outcomes(spark, str(tmp_path / "none")).count() == 0
    assert chunked.book_positions(chunks.file_chunks(spark, str(tmp_path / "none"))).count() == 0


@pytest.mark.parametrize("size", [5, 40, 300])
def test_books_in_chunks_equal_whole_books(spark, tmp_path, size):
    body = " ".join(f"token{chr(97 + i % 26)} the" for i in range(200))
    books = {
        "plain.txt": f"Title:   A  \nAuthor: B\n*** START OF THIS ***\n{body}\n*** END OF IT ***\nlast words",
        "far.txt": f"{body}\nTitle:\n\n  \n  Next line\nLanguage: en\r\nRelease Date:{' ' * 5000}June 1999\n",
        "priority.txt": f"***START OF {body} *** START OF {body} ***END OF {body} End of Project Gutenberg",
        "backward.txt": f"*** END OF {body} *** START OF {body}",
        "glued.txt": f"abc*** START OF def {body} ghi*** END OF jkl",
        "late.txt": f"{body} Release Date: May 2001",
        "open.txt": f"Title:  {body}\nTitle: second\n",
        "blank.txt": "Title:  \n \n",
        "none.txt": "",
    }
    for name, text in books.items():
        (tmp_path / name).write_bytes(text.encode())
    whole = materialize(chunks.book_outcomes(spark, str(tmp_path)).select("file_name", "text"), "whole")
    cut = chunks.file_chunks(spark, str(tmp_path), chunk_bytes=size)
    positions = materialize(chunked.book_positions(cut), "positions")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(chunked.book_metadata(positions)) == rows(metadata.book_metadata(whole))
    listing = chunks.file_listing(spark, str(tmp_path))
    terms = chunked.book_terms(listing, positions, str(tmp_path), size)
    assert rows(terms) == rows(tfidf.term_frequency(tfidf.term_vectors(whole)))
    words = word_count(whole.select(F.col("text").alias("value")))
    assert rows(chunked.chunk_word_count(cut)) == rows(words)


def test_view_is_cut(spark):
    target = book_files.write_books(spark, "/root/testdata/sf0.001")
    found = chunks.file_chunks(spark, target, chunk_bytes=book_files.CHUNK_BYTES)
    assert found.groupBy("file_name").count().filter("count > 3").count() > 20


def test_a_folder_is_listed_once(spark, folder):
    read = chunks.file_chunks(spark, str(folder), chunk_bytes=64)
    (folder / "later.txt").write_bytes(b"x")
    assert "later.txt" not in {r["file_name"] for r in read.collect()}


def test_listing_in_pieces(spark, folder, monkeypatch):
    from pyarrow import fs

    monkeypatch.setattr(chunks, "LISTED_ROWS", 2)
    (folder / "nowhere.txt").symlink_to(folder / "missing")
    (folder / "link.txt").symlink_to(folder / "0.txt")
    (folder / "inner.txt").symlink_to(folder / "folder.txt")
    store, root = fs.FileSystem.from_uri(f"file://{folder}")
    every = [x for x in store.get_file_info(fs.FileSelector(root)) if x.base_name.endswith(".txt")]
    wanted = {(x.base_name, x.path, x.size or 0, x.type == fs.FileType.File) for x in every}
    rows = [tuple(r) for r in chunks.file_listing(spark, str(folder)).collect()]
    assert len(rows) == len(wanted) and set(rows) == wanted


def test_small_ranges_of_a_file_are_neighbours(spark, folder):
    cut = chunks.ranges(chunks.written_listing(spark, str(folder)), 7)
    placed = chunks._dealt(cut).withColumn("task", F.spark_partition_id())
    tasks = placed.groupBy("path").agg(F.count_distinct("task").alias("n"), F.count("*").alias("rows"))
    assert tasks.filter("rows > 10").count() and not tasks.filter("n > 1").count()


def test_books_are_written_from_small_batches(spark, monkeypatch):
    sizes = []
    session = book_files.session_with
    monkeypatch.setattr(book_files, "session_with", lambda s, c: sizes.append(c) or session(s, c))
    book_files.write_books(spark, "/root/testdata/sf0.001")
    assert [int(v) for c in sizes for v in c.values()] == [book_files.BATCH_ROWS]
