import pytest

from corpusloom.functions import headers, names
from corpusloom.operators import metadata as op


def title(text):
    return headers.field(text, headers.TITLE)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Title: Moby Dick\nz", "Moby Dick"),
        ("Title:\nAuthor: X\n", "Author: X"),
        ("Title: A B\nz", ""),
        ("Title: A  \r\nz", "A  "),
        ("xTitle: in a line", "in a line"),
        ("title: lower\nTitle: first\nTitle: second", "first"),
        ("none", ""),
        ("", ""),
    ],
)
def test_plain_fields(value_of, text, expected):
    assert value_of(title, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Author: A B\nz", "A B"),
        ("Author:  Mark Twain \x1c　\nz", "Mark Twain"),
        ("Author:\n\nNext line\nz", "Next line"),
        ("Author:   \n", ""),
        ("Author: end", "end"),
        ("", ""),
    ],
)
def test_unicode_fields(value_of, text, expected):
    assert value_of(lambda c: headers.unicode_field(c, "Author:"), text) == expected


def test_every_python_space_is_stripped(value_of):
    import sys

    spaces = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
    assert value_of(headers.strip, f"{spaces}a{spaces}b{spaces}") == f"a{spaces}b"


@pytest.mark.parametrize(
    ("date", "ascii_year", "year"),
    [
        ("June 9, 2008 [EBook #2701]", "2008", 2008),
        ("soon [EBook #27011]", "2701", 2701),
        ("٢٠٠٨ and 1999", "1999", 2008),
        ("𝟐𝟎𝟎𝟖", "", 2008),
        ("0000", "0000", 0),
        ("12 34", "", None),
        ("", "", None),
    ],
)
def test_years(value_of, date, ascii_year, year):
    assert value_of(headers.year_text, date) == ascii_year
    assert value_of(headers.unicode_year, date) == year


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("by Mark Twain (1835-1910)", "Mark Twain"),
        ("BY X, (1835-1910)", "X"),
        ("Jr.", "Jr"),
        ("a\\", "a"),
        ("a,;", "a,"),
        ("Byron", "Byron"),
        ("A (1800) B (c. 1900) (1900?)", "A B (c. 1900)"),
        ("x (18350)", "x"),
        ("; ", ""),
        ("", ""),
    ],
)
def test_clean_author(value_of, name, expected):
    # a stripped name comes in, as from a header
    assert value_of(names.clean_author, name.strip()) == expected


@pytest.mark.parametrize(
    ("name", "key"),
    [("Mark  TWAIN", "mark twain"), ("O'Neil, J.", "oneil j"), ("Толстой", ""), ("é b", " b")],
)
def test_author_key(value_of, name, key):
    assert value_of(names.author_key, name) == key


def test_abbreviate(value_of):
    assert value_of(names.abbreviate, "x" * 38) == "x" * 38
    assert value_of(names.abbreviate, "x" * 39) == "x" * 38 + ".."


def test_metadata_and_summaries(spark):
    rows = [
        ("1.txt", "Title: Ab\nRelease Date: May 1999\nLanguage: English\n"),
        ("2.txt", "Title: Abcd\nRelease Date: none\nLanguage: French\nCharacter set encoding: UTF-8"),
        ("3.txt", "Release Date: 1999, 2001\nLanguage: English\n"),
        ("4.txt", ""),
    ]
    books = spark.createDataFrame(rows, "file_name STRING, text STRING")
    metadata = op.book_metadata(books)
    assert [tuple(r) for r in metadata.orderBy("file_name").collect()] == [
        ("1.txt", "Ab", "May 1999", "English", ""),
        ("2.txt", "Abcd", "none", "French", "UTF-8"),
        ("3.txt", "", "1999, 2001", "English", ""),
        ("4.txt", "", "", "", ""),
    ]
    assert [tuple(r) for r in op.books_per_year(metadata).collect()] == [(1999, 2)]
    assert dict(op.dated_books(metadata).dtypes)["release_year"] == "int"
    assert [tuple(r) for r in op.books_per_language(metadata).collect()] == [
        ("English", 2),
        ("French", 1),
    ]
    assert tuple(op.top_language(metadata).first()) == ("English", 2)
    assert op.average_title_length(metadata).first()[0] == 3.0
    stats = {r["summary"]: (r["title"], r["title_length"]) for r in op.title_statistics(metadata).collect()}
    assert stats["count"] == ("2", "2")
    assert stats["min"] == ("Ab", "2")
    assert stats["max"] == ("Abcd", "4")


def test_no_books_give_empty_tables_and_a_null_average(spark):
    metadata = op.book_metadata(spark.createDataFrame([], "file_name STRING, text STRING"))
    assert metadata.count() == 0
    assert op.books_per_year(metadata).count() == 0
    assert op.average_title_length(metadata).first()[0] is None
