"""Header fields of a book's text as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The header patterns. Unanchored and case-sensitive; the first
# match in the text wins and a blank field runs on to the next line.
TITLE = r"Title:\s*(.+?)(?:\r?\n|$)"
RELEASE_DATE = r"Release Date:\s*(.+?)(?:\r?\n|$)"
LANGUAGE = r"Language:\s*(.+?)(?:\r?\n|$)"
ENCODING = r"Character set encoding:\s*(.+?)(?:\r?\n|$)"
YEAR = r"(\d{4})"

# White space as Python's str.strip() and re's \s see it, as a Java class body.
UNICODE_SPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)


def field(text: Column, pattern: str) -> Column:
    """First capture, or '' where the header is missing. Not trimmed."""
    return F.regexp_extract(text, pattern, 1)


def unicode_field(text: Column, label: str) -> Column:
    """A labelled field under Unicode rules, stripped; '' where missing.

    Only a newline ends the value here, while in :func:`field` other Unicode
    line ends stop it too.
    """
    pattern = rf"{label}[{UNICODE_SPACE}]*([^\n]+?)(?:\r?\n|\z)"
    return strip(F.regexp_extract(text, pattern, 1))


def strip(value: Column) -> Column:
    return F.regexp_replace(
        value, rf"\A[{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+\z", ""
    )


def year_text(date: Column) -> Column:
    """First run of four ASCII digits, or ''."""
    return F.regexp_extract(date, YEAR, 1)


def unicode_year(date: Column) -> Column:
    """First run of four decimal digits of any script as BIGINT, or NULL."""
    digits = F.regexp_extract(date, r"(\p{Nd}{4})", 1)
    foreign = _foreign_digits()
    plain = "".join(str(unicodedata.digit(d)) for d in foreign)
    return F.translate(digits, foreign, plain).try_cast("bigint")


@cache
def _foreign_digits() -> str:
    """Every decimal digit outside ASCII."""
    characters = map(chr, range(128, sys.maxunicode + 1))
    return "".join(c for c in characters if unicodedata.category(c) == "Nd")
