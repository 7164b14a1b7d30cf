"""The influence network of a corpus: one pass over the texts, all else from its nodes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import influence as op
from corpusloom.operators.preview import first_rows
from corpusloom.sinks.files import write_csv
from corpusloom.workspace import materialize

# Fixed value: the window whose tables are saved and to which others compare.
BASE_WINDOW = 5


@dataclass(frozen=True)
class InfluenceNetwork:
    """Tables over the written author fields and their distinct nodes."""

    authors: DataFrame
    nodes: DataFrame
    fields: DataFrame  # one row for each book, with or without an author

    def counts(self) -> DataFrame:
        """``(measure, n)``: books in all, those with author and year, and authors."""
        books = self.fields.agg(F.lit("books").alias("measure"), F.count("*").alias("n"))
        named = self.authors.agg(
            F.lit("author books").alias("measure"),
            F.count("*").alias("n"),
        )
        spelled = self.authors.select("author_norm").distinct()
        authors = spelled.agg(F.lit("authors").alias("measure"), F.count("*").alias("n"))
        return books.unionByName(named).unionByName(authors)

    def sample(self, n: int = 10) -> DataFrame:
        return first_rows(self.authors, n, "file_name")

    def variants(self) -> DataFrame:
        return op.author_variants(self.authors)

    def edges(self, window: int = BASE_WINDOW) -> DataFrame:
        return op.influence_edges(self.nodes, window)

    def edges_of(self, author: str, window: int = BASE_WINDOW) -> DataFrame:
        return op.edges_of(self.nodes, author, window)

    def edge_index(self, window: int = BASE_WINDOW) -> DataFrame:
        """All edges in one row a node; ``expand_edges`` lists those of any authors."""
        return materialize(op.edge_index(self.nodes, window), "edge-index")

    def out_degree(self, window: int = BASE_WINDOW, distinct_authors: bool = False) -> DataFrame:
        return op.out_degree(self._points(distinct_authors), window)

    def in_degree(self, window: int = BASE_WINDOW, distinct_authors: bool = False) -> DataFrame:
        return op.in_degree(self._points(distinct_authors), window)

    def top_influential(self, window: int = BASE_WINDOW, n: int = 5) -> DataFrame:
        return op.top_authors(self.out_degree(window), n)

    def top_influenced(self, window: int = BASE_WINDOW, n: int = 5) -> DataFrame:
        return op.top_authors(self.in_degree(window), n)

    def top_of_windows(
        self, windows: Sequence[int] = op.WINDOWS, n: int = 5
    ) -> dict[int, tuple[DataFrame, DataFrame]]:
        """Most influential and most influenced authors by window. The degrees
        of all windows come out of one pass in each direction."""
        points = self._points(False)
        outward = materialize(op.degrees(points, windows, True), "out-degrees")
        inward = materialize(op.degrees(points, windows, False), "in-degrees")
        return {
            x: (
                op.top_authors(op.degree_ranking(outward, x, "author_from", "out_degree"), n),
                op.top_authors(op.degree_ranking(inward, x, "author_to", "in_degree"), n),
            )
            for x in windows
        }

    def sweep(self, windows: Sequence[int] = op.WINDOWS) -> DataFrame:
        return op.window_sweep(op.book_years(self.nodes), windows, BASE_WINDOW)

    def save(self, folder: str, window: int = BASE_WINDOW, edges: bool = False) -> None:
        """Out-degrees and in-degrees under ``folder``. With ``edges`` also the edges,
        which are quadratic in the nodes; the degrees are not computed from them."""
        if edges:
            write_csv(self.edges(window), f"{folder}/edges")
        write_csv(self.out_degree(window), f"{folder}/out_degree")
        write_csv(self.in_degree(window), f"{folder}/in_degree")

    def _points(self, distinct_authors: bool) -> DataFrame:
        return op.author_spans(self.nodes) if distinct_authors else op.book_years(self.nodes)


def network(books: DataFrame) -> InfluenceNetwork:
    fields = materialize(op.author_fields(books), "author-fields")
    authors = op.authors(fields)
    return InfluenceNetwork(authors, materialize(op.nodes(authors), "nodes"), fields)
