"""Books most similar to one book, over exact or hashed terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import similarity as op
from corpusloom.operators.postings import Found, posting_index, search
from corpusloom.operators.tfidf import term_vectors
from corpusloom.sinks.files import write_report
from corpusloom.workspace import materialize

# Fixed value: the book looked up by default.
TARGET = "200.txt"


@dataclass(frozen=True)
class SimilarityReport:
    """The scores of all books against ``target``, as a written table."""

    target: str | None
    similarities: DataFrame

    def books(self) -> DataFrame:
        """The names of all books, the target's among them."""
        names = self.similarities.select("file_name")
        if self.target is None:
            return names
        # one row is added to a written table
        own = names.sparkSession.createDataFrame([(self.target,)], names.schema)
        return names.unionByName(own)

    def counts(self) -> DataFrame:
        """``(measure, n)``: books in all and those like the target at all."""
        alike = self.similarities.filter("similarity > 0")
        sizes = [("books", self.books()), ("alike", alike)]
        found = [df.agg(F.lit(name).alias("measure"), F.count("*").alias("n")) for name, df in sizes]
        return found[0].unionByName(found[1])

    def top(self, n: int = 5) -> DataFrame:
        return op.top_similar(self.similarities, n)

    def ranked(self) -> DataFrame:
        return op.ranked(self.similarities)

    def lines(self, n: int = 5) -> DataFrame:
        return op.report(self.similarities, self.target, n)

    def save(self, path: str, n: int = 5) -> None:
        write_report(self.lines(n), path)


def exact(books: DataFrame, wanted: str = TARGET) -> SimilarityReport:
    """One term, one dimension."""
    vectors = materialize(term_vectors(books), "term-vectors")
    target = _target(vectors, wanted)
    return _scored(target, op.exact_similarity(vectors, target))


def top_by_index(books: DataFrame, wanted: str = TARGET, n: int = 5) -> Found:
    """The top of :func:`exact` from an index of postings, most of which stay unread."""
    vectors = materialize(term_vectors(books), "term-vectors")
    return search(posting_index(vectors), _target(vectors, wanted), n)


def hashed(books: DataFrame, wanted: str = TARGET, buckets: int = 65536) -> SimilarityReport:
    """Terms share ``buckets`` dimensions by hash, so that unlike ones may meet."""
    vectors = op.hashed_vectors(books, buckets)
    target = _target(vectors, wanted)
    return _scored(target, op.vector_similarity(vectors, target))


def _scored(target: str | None, similarities: DataFrame) -> SimilarityReport:
    return SimilarityReport(target, materialize(similarities, "similarities"))


def _target(vectors: DataFrame, wanted: str) -> str | None:
    return op.target_book(vectors, wanted).first()["target"]
