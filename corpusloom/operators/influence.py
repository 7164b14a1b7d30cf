"""Influence between authors: who published how many years before whom.

An author's book of one year influences every book of another author that came
out at least X years later. Graph nodes are the names as written; spellings of
one author share a key and never influence each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import headers, names
from corpusloom.operators.joins import lookup_join
from corpusloom.operators.positions import with_position
from corpusloom.workspace import materialize

WINDOWS = (1, 5, 10, 20)


def author_fields(books: DataFrame) -> DataFrame:
    """``(file_name, author_original, release_year)`` of every book; a missing
    author is '', a missing year NULL."""
    text = F.col("text")
    return books.select(
        "file_name",
        names.clean_author(headers.unicode_field(text, "Author:")).alias("author_original"),
        headers.unicode_year(headers.unicode_field(text, "Release Date:")).alias("release_year"),
    )


def authors(fields: DataFrame) -> DataFrame:
    """The books that name an author and a year other than 0, with the key
    ``author_norm`` that joins spellings.

    Pass written fields: Spark would look through the texts once for this
    filter and again for its output.
    """
    kept = fields.filter((F.col("author_original") != "") & (F.col("release_year") != 0))
    return kept.withColumn("author_norm", names.author_key(F.col("author_original")))


def author_spellings(author_table: DataFrame) -> DataFrame:
    """``(author_norm, author_original, copies)``."""
    spelled = author_table.groupBy("author_norm", "author_original")
    return spelled.agg(F.count("*").alias("copies"))


def author_book_counts(spellings: DataFrame) -> DataFrame:
    """``(author_norm, book_count, spellings)``."""
    return spellings.groupBy("author_norm").agg(
        F.sum("copies").alias("book_count"), F.count("*").alias("spellings")
    )


def author_variants(author_table: DataFrame) -> DataFrame:
    """``(author_norm, book_count, author_original, copies)``: one row for each spelling
    of a key, with the books of the key and of the spelling."""
    spellings = materialize(author_spellings(author_table), "spellings")
    totals = materialize(author_book_counts(spellings), "author-totals")
    joined = lookup_join(spellings, totals, ["author_norm"], "spellings")
    found = joined.select("author_norm", "book_count", "author_original", "copies")
    return found.orderBy(F.desc("book_count"), "author_norm", "author_original")


def nodes(author_table: DataFrame) -> DataFrame:
    """Distinct ``(author_original, author_norm, release_year)``.

    Edges depend on nothing else, so edges between nodes are distinct as they are.
    """
    return author_table.select("author_original", "author_norm", "release_year").distinct()


def book_years(node_table: DataFrame) -> DataFrame:
    """Points for degrees that count edges: one per author and year."""
    year = F.col("release_year")
    return node_table.select(
        F.col("author_original").alias("author"),
        "author_norm",
        year.alias("from_year"),
        year.alias("to_year"),
    )


def author_spans(node_table: DataFrame) -> DataFrame:
    """Points for degrees that count authors: one per author.

    A influences B at all if A's first year lies far enough before B's last.
    """
    by_author = node_table.groupBy("author_original", "author_norm")
    return by_author.agg(
        F.min("release_year").alias("from_year"), F.max("release_year").alias("to_year")
    ).withColumnRenamed("author_original", "author")


def reach(points: DataFrame, windows: Sequence[int], outward: bool) -> DataFrame:
    """``(author_norm, year, points, x1, x2, ..)``: how many points of other
    authors one point of that key and year reaches, for each window.

    All points far enough away less those of the same key. Both are running
    sums over counts by year, so no pair of points is formed. A year has four
    digits: a key has under 10 000 of them, and so has the whole corpus.
    """
    own, other = ("from_year", "to_year") if outward else ("to_year", "from_year")
    ends = points.select(
        "author_norm",
        F.inline(
            F.array(
                F.struct(F.col(own).alias("year"), F.lit(1).alias("own"), F.lit(0).alias("other")),
                F.struct(F.col(other).alias("year"), F.lit(0).alias("own"), F.lit(1).alias("other")),
            )
        ),
    )
    by_key = ends.groupBy("author_norm", "year").agg(
        F.sum("own").alias("points"), F.sum("other").alias("other")
    )
    by_year = ends.groupBy("year").agg(F.sum("other").alias("other"))

    order = F.desc("year") if outward else F.asc("year")

    def far(partition: Column | str, x: int) -> Column:
        frame = Window.partitionBy(partition).orderBy(order)
        running = F.sum("other").over(frame.rangeBetween(Window.unboundedPreceding, -x))
        return F.coalesce(running, F.lit(0))

    everyone = by_year.select("year", *[far(F.lit(0), x).alias(f"all{x}") for x in windows])
    same_key = by_key.select(
        "author_norm",
        "year",
        "points",
        *[far("author_norm", x).alias(f"same{x}") for x in windows],
    ).filter(F.col("points") > 0)
    reached = [(F.col(f"all{x}") - F.col(f"same{x}")).alias(f"x{x}") for x in windows]
    return same_key.join(F.broadcast(everyone), "year").select(
        "author_norm", "year", "points", *reached
    )


def degrees(points: DataFrame, windows: Sequence[int], outward: bool) -> DataFrame:
    """``(author, x1, x2, ..)``: the degree of each author for each window.

    ``points`` is read twice; pass a written table.
    """
    lookup = materialize(reach(points, windows, outward), "reach")
    own = "from_year" if outward else "to_year"
    placed = points.withColumnRenamed(own, "year").select("author", "author_norm", "year")
    joined = lookup_join(placed, lookup, ["author_norm", "year"], "points")
    return joined.groupBy("author").agg(*[F.sum(f"x{x}").alias(f"x{x}") for x in windows])


def degree_ranking(table: DataFrame, window: int, author: str, degree: str) -> DataFrame:
    """``(<author>, <degree>)`` of one window of a :func:`degrees` table,
    highest first; authors with none are left out."""
    named = table.select(F.col("author").alias(author), F.col(f"x{window}").alias(degree))
    return named.filter(F.col(degree) > 0).orderBy(F.desc(degree), author)


def out_degree(points: DataFrame, window: int) -> DataFrame:
    """``(author_from, out_degree)``."""
    table = degrees(points, [window], outward=True)
    return degree_ranking(table, window, "author_from", "out_degree")


def in_degree(points: DataFrame, window: int) -> DataFrame:
    """``(author_to, in_degree)``."""
    table = degrees(points, [window], outward=False)
    return degree_ranking(table, window, "author_to", "in_degree")


def top_authors(degree_table: DataFrame, n: int = 5) -> DataFrame:
    """``(rank, <author>, label, <degree>)`` of the ``n`` highest degrees."""
    author, degree = degree_table.columns
    order = [F.desc(degree), F.asc(author)]
    # the window sees the n rows that are left
    place = F.row_number().over(Window.orderBy(*order)).alias("rank")
    label = names.abbreviate(F.col(author)).alias("label")
    return degree_table.orderBy(*order).limit(n).select(place, author, label, degree)


def window_sweep(points: DataFrame, windows: Sequence[int] = WINDOWS, base: int = 5) -> DataFrame:
    """``(window_years, edges, ratio)``: edges for each window, and over those
    of the ``base`` window. One pass for all windows, and no edge is formed."""
    tried = sorted({*windows, base})
    totals = reach(points, tried, True).agg(
        *[F.coalesce(F.sum(F.col("points") * F.col(f"x{x}")), F.lit(0)).alias(f"x{x}") for x in tried]
    )
    over = F.col(f"x{base}")
    rows = [
        F.struct(
            F.lit(x).alias("window_years"),
            F.col(f"x{x}").alias("edges"),
            F.when(over > 0, F.col(f"x{x}") / over).otherwise(0.0).alias("ratio"),
        )
        for x in windows
    ]
    return totals.select(F.inline(F.array(*rows)))


def influence_edges(node_table: DataFrame, window: int, block_nodes: int = 1024) -> DataFrame:
    """``(author_from, author_to, year_from, year_to, year_diff)``, distinct.

    The result is quadratic by nature; only its work is spread evenly. Nodes in
    year order fall into blocks of about ``block_nodes``, a year with more is
    dealt over several by hash. Each node goes to the blocks that can hold a
    partner, and two blocks meet under one key: an equi join whose keys are all
    alike in size, however many nodes one year or author has.
    """
    spans = _block_spans(node_table, window, block_nodes)
    placed = node_table.join(F.broadcast(spans), "release_year").withColumn(
        "block",
        F.col("first_block")
        + F.pmod(
            F.xxhash64("author_original"), F.col("last_block") - F.col("first_block") + 1
        ),
    )
    earlier = placed.filter(F.col("later_block").isNotNull()).select(
        F.col("author_original").alias("author_from"),
        F.col("author_norm").alias("norm_from"),
        F.col("release_year").alias("year_from"),
        F.col("block").alias("block_from"),
        F.explode(F.sequence("later_block", "final_block")).alias("block_to"),
    )
    later = placed.filter(F.col("earlier_block").isNotNull()).select(
        F.col("author_original").alias("author_to"),
        F.col("author_norm").alias("norm_to"),
        F.col("release_year").alias("year_to"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), "earlier_block")).alias("block_from"),
        F.col("block").alias("block_to"),
    )
    met = earlier.join(later.hint("merge"), ["block_from", "block_to"])
    apart = F.col("year_to") - F.col("year_from")
    return met.filter((apart >= window) & (F.col("norm_from") != F.col("norm_to"))).select(
        "author_from", "author_to", "year_from", "year_to", apart.alias("year_diff")
    )


def edges_of(node_table: DataFrame, author: str, window: int) -> DataFrame:
    """The edges of :func:`influence_edges` that begin or end at ``author``, a name as
    written. Linear in the nodes: the author has one node a year, so those are broadcast.
    """
    own = node_table.filter(F.col("author_original") == author).select(
        F.col("author_norm").alias("own_norm"), F.col("release_year").alias("own_year")
    )
    met = node_table.join(F.broadcast(own), F.col("author_norm") != F.col("own_norm"))
    apart = F.col("release_year") - F.col("own_year")
    sides = [
        met.filter(apart >= window).select(
            F.lit(author).alias("author_from"),
            F.col("author_original").alias("author_to"),
            F.col("own_year").alias("year_from"),
            F.col("release_year").alias("year_to"),
            apart.alias("year_diff"),
        ),
        met.filter(-apart >= window).select(
            F.col("author_original").alias("author_from"),
            F.lit(author).alias("author_to"),
            F.col("release_year").alias("year_from"),
            F.col("own_year").alias("year_to"),
            (-apart).alias("year_diff"),
        ),
    ]
    return sides[0].unionByName(sides[1])


def edge_index(node_table: DataFrame, window: int) -> DataFrame:
    """All edges of a window in as many rows as there are nodes.

    ``(position, author_original, author_norm, release_year, partners_from, own_partners,
    out_edges)``: nodes are numbered from 1 by year, so the partners of a node are all
    positions from ``partners_from`` on, less the ``own_partners`` of them that have its
    own key. ``node_table`` is read several times; pass a written table.
    """
    order = [F.asc("release_year"), F.asc("author_original"), F.asc("author_norm")]
    near = (Window.unboundedPreceding, window - 1)
    by_key = node_table.groupBy("author_norm", "release_year").agg(F.count("*").alias("n"))
    of_key = Window.partitionBy("author_norm")
    own = materialize(
        by_key.select(
            "author_norm",
            "release_year",
            "n",
            (
                F.sum("n").over(of_key)
                - F.sum("n").over(of_key.orderBy("release_year").rangeBetween(*near))
            ).alias("own_partners"),
        ),
        "own-partners",
    )
    # a year has four digits, so this window sees under 10 000 rows
    every_year = Window.partitionBy(F.lit(0))
    before = F.sum("n").over(every_year.orderBy("release_year").rangeBetween(*near))
    by_year = own.groupBy("release_year").agg(F.sum("n").alias("n"))
    starts = by_year.select(
        "release_year",
        (before + 1).alias("partners_from"),
        (F.sum("n").over(every_year) - before).alias("later"),
    )
    placed = with_position(node_table, order)
    found = lookup_join(placed, own, ["author_norm", "release_year"], "n")
    return found.join(F.broadcast(starts), "release_year").select(
        "position",
        "author_original",
        "author_norm",
        "release_year",
        "partners_from",
        "own_partners",
        (F.col("later") - F.col("own_partners")).alias("out_edges"),
    )


def expand_edges(
    index: DataFrame, sources: DataFrame | None = None, block_nodes: int = 1024
) -> DataFrame:
    """The edges of a written :func:`edge_index`, as :func:`influence_edges` gives them;
    with ``sources``, a table ``(author_original)``, only those that begin at one of them.

    Positions fall into blocks of ``block_nodes``. Only pairs of blocks that hold edges of
    the wanted sources meet, and a key of the join is one such pair, so all are alike in size.
    """

    def block(place: str) -> Column:
        return F.floor((F.col(place) - 1) / block_nodes)

    begins = index.filter(F.col("out_edges") > 0)
    if sources is not None:
        begins = begins.join(sources.distinct(), "author_original", "left_semi")
    last = index.agg(F.coalesce(F.max("position"), F.lit(1))).first()[0]
    final = F.lit((last - 1) // block_nodes).cast("bigint")
    starts = begins.select("*", block("position").alias("block_from"))
    earlier = starts.select(
        F.col("author_original").alias("author_from"),
        F.col("author_norm").alias("norm_from"),
        F.col("release_year").alias("year_from"),
        "partners_from",
        "block_from",
        F.explode(F.sequence(block("partners_from"), final)).alias("block_to"),
    )
    first_to = starts.groupBy("block_from").agg(F.min("partners_from").alias("partners_from"))
    pairs = first_to.select(
        "block_from", F.explode(F.sequence(block("partners_from"), final)).alias("block_to")
    )
    later = index.select(
        F.col("author_original").alias("author_to"),
        F.col("author_norm").alias("norm_to"),
        F.col("release_year").alias("year_to"),
        "position",
        block("position").alias("block_to"),
    ).join(pairs, "block_to")
    met = earlier.join(later.hint("merge"), ["block_from", "block_to"])
    partner = (F.col("position") >= F.col("partners_from")) & (F.col("norm_from") != F.col("norm_to"))
    return met.filter(partner).select(
        "author_from",
        "author_to",
        "year_from",
        "year_to",
        (F.col("year_to") - F.col("year_from")).alias("year_diff"),
    )


def _block_spans(node_table: DataFrame, window: int, block_nodes: int) -> DataFrame:
    """One row per year: its blocks, and those of the years far enough away.

    Under 10 000 rows, since a year has four digits.
    """
    by_year = node_table.groupBy("release_year").agg(F.count("*").alias("n"))
    every_year = Window.partitionBy(F.lit(0))
    up = every_year.orderBy("release_year")
    down = every_year.orderBy(F.desc("release_year"))
    before = F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    blocks = by_year.withColumn("before", before).select(
        "release_year",
        F.floor(F.col("before") / block_nodes).alias("first_block"),
        F.floor((F.col("before") + F.col("n") - 1) / block_nodes).alias("last_block"),
    )
    far = (Window.unboundedPreceding, -window)
    return blocks.select(
        "*",
        F.min("first_block").over(down.rangeBetween(*far)).alias("later_block"),
        F.max("last_block").over(up.rangeBetween(*far)).alias("earlier_block"),
        F.max("last_block").over(every_year).alias("final_block"),
    )
