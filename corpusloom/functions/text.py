"""Cleaning, boilerplate removal and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers around a book's own text, in order of preference.
START_MARKERS = ("*** START OF", "***START OF", "*END*THE SMALL PRINT")
END_MARKERS = ("*** END OF", "***END OF", "End of Project Gutenberg")

# Fixed value: the separators between words in a word count. A vertical tab is
# not one of them, although the punctuation rule keeps it.
WORD_SEPARATORS = r"[ \t\n\r\f]+"


# Fixed value: what a word count deletes, `[^a-zA-Z0-9\s]`. The characters are listed one by
# one, since Java keeps them as bits then; with several tasks in one process a union of
# ranges and `\s` is slower by far.
PUNCTUATION = rf"[^{ascii_letters}{digits} \t\n\x0B\f\r]+"


def words(line: Column) -> Column:
    """Array of words: punctuation deleted, case and digits kept.

    Leading or trailing separators leave empty strings; drop them after the
    explode, where the test stays inside generated code.
    """
    bare = F.regexp_replace(line, PUNCTUATION, "")
    return F.split(bare, WORD_SEPARATORS)


def main_content(text: Column) -> Column:
    """The text from its start marker up to its end marker.

    The first marker of each list that occurs anywhere wins, the start marker
    stays in, and an end before the start leaves nothing.
    """
    start = _position(text, START_MARKERS, F.lit(1))
    end = _position(text, END_MARKERS, F.length(text) + 1)
    return F.substring(text, start, F.greatest(end - start, F.lit(0)))


def _position(text: Column, markers: Sequence[str], default: Column) -> Column:
    found = [F.nullif(F.locate(marker, text), F.lit(0)) for marker in markers]
    return F.coalesce(*found, default)


def clean_text(content: Column) -> Column:
    """Lower case, every non-letter a space, runs of white space one space.

    Both rules at once: whatever lies between letters becomes one space.
    """
    return F.regexp_replace(F.lower(content), "[^a-z]+", " ")


def tokens(text: Column, min_length: int = 2) -> Column:
    """Lower-cased tokens between white space, short ones dropped."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: F.length(t) >= min_length)


def without_stop_words(token_array: Column, stop_words: Sequence[str]) -> Column:
    listed = [word.lower() for word in stop_words]
    return F.filter(token_array, lambda t: ~F.lower(t).isin(listed))


def content_terms(content: Column, stop_words: Sequence[str], min_length: int = 2) -> Column:
    """Clean, tokenise and drop stop words in one pass over the text.

    Equal to ``without_stop_words(tokens(clean_text(content)))``: what is left
    between non-letters of the lower-cased text is the token.
    """
    return F.filter(letter_runs(content), lambda t: is_term(t, stop_words, min_length))


def letter_runs(content: Column) -> Column:
    """What is left between non-letters of the lower-cased text, '' at an end among it."""
    return F.split(F.lower(content), "[^a-z]+")


def is_term(run: Column, stop_words: Sequence[str], min_length: int = 2) -> Column:
    return (F.length(run) >= min_length) & ~run.isin([word.lower() for word in stop_words])


def term_counts(term_array: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's terms, without a shuffle.

    Equal terms are neighbours once sorted, so a count is the distance between
    two run starts.
    """

    def starts(ordered: Column) -> Column:
        marks = F.transform(
            ordered,
            lambda term, i: F.when(~term.eqNullSafe(F.get(ordered, i - 1)), i),
        )
        return F.filter(marks, lambda i: i.isNotNull())

    def runs(ordered: Column, begins: Column) -> Column:
        return F.transform(
            begins,
            lambda b, i: F.struct(
                F.get(ordered, b).alias("term"),
                (F.coalesce(F.get(begins, i + 1), F.size(ordered)) - b)
                .cast("bigint")
                .alias("tf"),
            ),
        )

    return _let(
        F.sort_array(term_array),
        lambda ordered: _let(starts(ordered), lambda begins: runs(ordered, begins)),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain reference would be copied into every lambda when Catalyst pushes a
    filter below the projection.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
