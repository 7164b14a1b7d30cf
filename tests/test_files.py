import os

import pytest

from corpusloom.operators.word_count import sorted_word_count
from corpusloom.plans import word_count as plan
from corpusloom.sinks import files as sinks
from corpusloom.sources import files as sources


def loaded(df):
    return {r["file_name"]: r["text"] for r in df.collect()}


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "corpus"
    place.mkdir()
    (place / "a b.txt").write_bytes("one\r\ntwo\rthree\n".encode())
    (place / "bad.txt").write_bytes(b"a\xffb\xef\xbf\xbdc\x1a0\x1a1\xed\xa0\x80d\xe2\x82")
    (place / "é%20.txt").write_bytes("﻿x�y".encode())
    (place / "1+1 é.txt").write_text("plus")
    (place / "upper.TXT").write_text("no")
    (place / "broken.txt").symlink_to(place / "nowhere")
    (place / "notes.md").write_text("no")
    (place / "sub").mkdir()
    (place / "sub" / "c.txt").write_text("no")
    return place


def test_books_are_the_txt_files_of_one_folder(spark, folder):
    found = loaded(sources.books(spark, str(folder)))
    assert found == {
        "1+1 é.txt": "plus",
        "a b.txt": "one\ntwo\nthree\n",
        "bad.txt": "ab�c\x1a0\x1a1d",
        "é%20.txt": "﻿x�y",
    }
    for name in found:
        with open(folder / name, encoding="utf-8", errors="ignore") as file:
            assert file.read() == found[name]


def test_folders_named_like_partitions_do_not_hide_books(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "k=v").mkdir()
    (tmp_path / "k=v" / "b.txt").write_text("y")
    assert loaded(sources.books(spark, str(tmp_path))) == {"a.txt": "x"}


def test_empty_folder_gives_a_typed_empty_table(spark, tmp_path):
    found = sources.books(spark, str(tmp_path))
    assert found.count() == 0
    assert found.schema.simpleString() == "struct<file_name:string,text:string>"


def test_files_that_vanish_are_left_out_and_named(spark, folder):
    tolerant = sources.books(spark, str(folder), skip_unreadable=True)
    strict = sources.books(spark, str(folder))
    missing = sources.unreadable_books(spark, str(folder))
    assert missing.count() == 0
    os.remove(folder / "bad.txt")
    assert sorted(loaded(tolerant)) == ["1+1 é.txt", "a b.txt", "é%20.txt"]
    with pytest.raises(Exception, match="bad.txt"):
        strict.collect()


def test_files_of_no_bytes_are_books(spark, tmp_path):
    (tmp_path / "none.txt").write_bytes(b"")
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "none.md").write_bytes(b"")
    assert loaded(sources.books(spark, str(tmp_path))) == {"a.txt": "x", "none.txt": ""}
    assert sources.unreadable_books(spark, str(tmp_path)).count() == 0


def test_hidden_names_stop_a_job_or_are_named(spark, tmp_path):
    for name in ("_a.txt", ".b.txt", "c.txt"):
        (tmp_path / name).write_text("x")
    with pytest.raises(ValueError, match="_a.txt"):
        sources.books(spark, str(tmp_path))
    assert loaded(sources.books(spark, str(tmp_path), skip_unreadable=True)) == {"c.txt": "x"}
    missing = sources.unreadable_books(spark, str(tmp_path))
    assert sorted(r["file_name"] for r in missing.collect()) == [".b.txt", "_a.txt"]


def test_lines_end_at_any_newline(spark, tmp_path):
    (tmp_path / "l.txt").write_bytes(b"a\nb\r\nc\rd")
    rows = sources.lines(spark, str(tmp_path / "l.txt")).collect()
    assert [r["value"] for r in rows] == ["a", "b", "c", "d"]


def test_split_size_bounds_tasks_of_one_read_only(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("some words here\n" * 4096)
    size = path.stat().st_size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    split = sources.lines(spark, str(path), size // 4)
    assert split.rdd.getNumPartitions() == 4
    assert sources.lines(spark, str(path), size * 2).rdd.getNumPartitions() == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert split.sparkSession.conf.get("spark.sql.shuffle.partitions") == "8"
    assert {r["word"]: r["count"] for r in sorted_word_count(split).collect()} == {
        "here": 4096,
        "some": 4096,
        "words": 4096,
    }


def test_word_count_files_are_sorted_and_never_replaced(spark, tmp_path):
    source, target = tmp_path / "in.txt", str(tmp_path / "out")
    source.write_text("b a\nB b\n")
    plan.run(spark, str(source), target)
    written = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert written == "B\t1\na\t1\nb\t2\n"
    assert sinks.read_counts(spark, target).count() == 3
    with pytest.raises(Exception, match="already exists"):
        plan.run(spark, str(source), target, 1024)


def test_vertical_tabs_stay_part_of_words(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\x0ba a b\x0b b\n")
    plan.run(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    found = {(r["word"], r["count"]) for r in sinks.read_counts(spark, str(tmp_path / "out")).collect()}
    assert found == {("\x0ba", 1), ("a", 1), ("b\x0b", 1), ("b", 1)}


def test_split_sweep_times_each_size(spark, tmp_path):
    source = tmp_path / "in.txt"
    source.write_text("b a\n" * 100)
    rows = plan.split_sweep(spark, str(source)).collect()
    assert [r["split_bytes"] for r in rows] == [None, 16777216, 268435456, 4194304]
    assert all(r["partitions"] >= 1 and r["ms"] >= 0 for r in rows)


def test_csv_keeps_empty_strings_apart_from_null(spark, tmp_path):
    rows = spark.createDataFrame([("a", "", None, 'q"x')], "a STRING, b STRING, c STRING, d STRING")
    path = str(tmp_path / "csv")
    sinks.write_csv(rows, path)
    sinks.write_csv(rows, path)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert text == 'a,"",,"q\\"x"\n'
