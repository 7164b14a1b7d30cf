"""Author names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.headers import UNICODE_SPACE, strip


def clean_author(name: Column) -> Column:
    """Drop a leading 'by', life dates in brackets and one trailing mark."""
    no_by = F.regexp_replace(name, rf"(?i)\Aby[{UNICODE_SPACE}]+", "")
    no_dates = F.regexp_replace(no_by, rf"[{UNICODE_SPACE}]*\(\p{{Nd}}{{4}}[^)]*\)", "")
    no_mark = F.regexp_replace(no_dates, r"[,\\.;]\z", "")
    return strip(no_mark)


def author_key(name: Column) -> Column:
    """Key that joins spellings: lower case, letters, digits and single blanks.

    Not trimmed, and empty for a name without a single Latin letter.
    """
    kept = F.regexp_replace(F.lower(name), r"[^a-z0-9\s]", "")
    return F.regexp_replace(kept, r"\s+", " ")


def abbreviate(name: Column, width: int = 38) -> Column:
    """Names longer than ``width`` cut there, with '..' in place of the rest."""
    short = F.concat(F.substring(name, 1, width), F.lit(".."))
    return F.when(F.length(name) > width, short).otherwise(name)
