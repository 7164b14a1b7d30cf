"""Header metadata of a corpus: one pass over the texts, all else from its result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import metadata as op
from corpusloom.operators.preview import first_rows
from corpusloom.sinks.files import write_csv
from corpusloom.workspace import materialize


@dataclass(frozen=True)
class MetadataReport:
    """Tables over one written metadata table."""

    metadata: DataFrame

    def sample(self, n: int = 10, width: int = 50) -> DataFrame:
        return first_rows(self.metadata, n, "file_name", width)

    def counts(self) -> DataFrame:
        """``(measure, n)``: books in all and books with a year."""
        dated = op.dated_books(self.metadata)
        return _measure(self.metadata, "books").unionByName(_measure(dated, "dated books"))

    def per_year(self) -> DataFrame:
        return op.books_per_year(self.metadata)

    def per_language(self) -> DataFrame:
        return op.books_per_language(self.metadata)

    def top_language(self) -> DataFrame:
        return op.top_language(self.metadata)

    def average_title_length(self) -> DataFrame:
        return op.average_title_length(self.metadata)

    def title_statistics(self) -> DataFrame:
        return op.title_statistics(self.metadata)

    def save(self, path: str) -> None:
        write_csv(self.metadata, path)


def _measure(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("measure"), F.count("*").alias("n"))


def report(books: DataFrame) -> MetadataReport:
    return MetadataReport(materialize(op.book_metadata(books), "metadata"))
