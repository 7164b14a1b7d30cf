"""Every operator as a query ``(spark, folder of tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import book_files
from checks.books_view import books, documents
from corpusloom.functions import text
from corpusloom.operators import influence as net
from corpusloom.operators import metadata as meta
from corpusloom.operators import tfidf
from corpusloom.operators.positions import with_position
from corpusloom.operators.preview import first_rows
from corpusloom.operators.similarity import (
    by_similarity,
    hashed_vectors,
    target_book,
    vector_entries,
)
from corpusloom.operators.word_count import sorted_word_count, word_count
from corpusloom.plans import influence, metadata, similarity
from corpusloom.plans.word_count import SPLIT_SIZES
from corpusloom.plans.word_count import run as count_files
from corpusloom.sinks.files import read_counts, write_csv
from corpusloom.sources.files import lines
from corpusloom.workspace import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]

METADATA_SCHEMA = (
    "file_name STRING, title STRING, release_date STRING, language STRING, encoding STRING"
)
EDGES_SCHEMA = (
    "author_from STRING, author_to STRING, year_from BIGINT, year_to BIGINT, year_diff BIGINT"
)


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


# Word count


def words(spark: SparkSession, folder: str) -> DataFrame:
    return sorted_word_count(documents(spark, folder), "text")


def line_files(spark: SparkSession, folder: str) -> str:
    path = new_path(spark, "lines")
    documents(spark, folder).select("text").write.text(path)
    return path


def words_of_files(spark: SparkSession, folder: str) -> DataFrame:
    result = new_path(spark, "counts")
    count_files(spark, line_files(spark, folder), result)
    return read_counts(spark, result)


def words_by_split_size(spark: SparkSession, folder: str) -> DataFrame:
    path = line_files(spark, folder)
    totals = []
    for size in SPLIT_SIZES:
        counts = word_count(lines(spark, path, size))
        row = counts.agg(F.count("*"), F.sum("count")).first()
        totals.append((size, *row))
    return spark.createDataFrame(totals, "split_bytes BIGINT, words BIGINT, total BIGINT")


# Metadata


def book_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return meta.book_metadata(books(spark, folder))


def metadata_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "metadata-csv")
    metadata.report(books(spark, folder)).save(path)
    return spark.read.schema(METADATA_SCHEMA).option("nullValue", "\\N").csv(path)


def metadata_sample(spark: SparkSession, folder: str) -> DataFrame:
    # header fields are taken from the ten texts only
    first = books(spark, folder).orderBy("file_name").limit(10)
    return first_rows(meta.book_metadata(first), 10, "file_name", 30)


def _of_metadata(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(metadata.report(books(spark, folder)).metadata)


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    view = books(spark, folder)
    sizes = metadata.report(view).counts()
    network = influence.network(view)
    vectors = tfidf.term_vectors(view)
    for name, df in (("author books", network.authors), ("vectors", vectors)):
        sizes = sizes.unionByName(df.agg(F.lit(name).alias("measure"), F.count("*").alias("n")))
    edges = network.sweep([5]).select(F.lit("edges").alias("measure"), F.col("edges").alias("n"))
    return sizes.unionByName(edges)


def average_title_length(table: DataFrame) -> DataFrame:
    return _rounded(meta.average_title_length(table), "avg_length")


def title_statistics(table: DataFrame) -> DataFrame:
    found = meta.title_statistics(table)
    length = F.round(F.col("title_length").cast("double"), 6)
    return found.select("summary", "title", length.alias("title_length"))


# Influence


def _network(use: Callable[[influence.InfluenceNetwork], DataFrame]) -> Query:
    return lambda spark, folder: use(influence.network(books(spark, folder)))


def edges_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "network-csv")
    influence.network(books(spark, folder)).save(path, edges=True)
    return spark.read.schema(EDGES_SCHEMA).csv(f"{path}/edges")


def degrees_csv(spark: SparkSession, folder: str) -> DataFrame:
    network = influence.network(books(spark, folder))
    path = new_path(spark, "degrees-csv")
    write_csv(network.out_degree(), f"{path}/out")
    write_csv(network.in_degree(), f"{path}/in")
    reader = spark.read.schema("author STRING, degree BIGINT")
    sides = [
        reader.csv(f"{path}/{side}").select(F.lit(side).alias("side"), "author", "degree")
        for side in ("out", "in")
    ]
    return sides[0].unionByName(sides[1])


def window_sweep(spark: SparkSession, folder: str) -> DataFrame:
    found = influence.network(books(spark, folder)).sweep()
    label = F.format_string("%.2fx", "ratio").alias("change")
    return found.select("window_years", "edges", F.round("ratio", 6).alias("ratio"), label)


# Text and similarity


def main_content(spark: SparkSession, folder: str) -> DataFrame:
    return tfidf.content(books(spark, folder))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return tfidf.cleaned(books(spark, folder))


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    found = text.tokens(F.col("clean_text"))
    return cleaned(spark, folder).select("file_name", F.array_join(found, " ").alias("tokens"))


def filtered_tokens(spark: SparkSession, folder: str) -> DataFrame:
    found = tfidf.filtered_tokens(books(spark, folder))
    return found.select("file_name", F.array_join("filtered_tokens", " ").alias("tokens"))


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(tfidf.term_vectors(books(spark, folder)), "term-vectors")


def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return tfidf.term_frequency(tfidf.term_vectors(books(spark, folder)))


def _idf(vectors: DataFrame) -> DataFrame:
    found = tfidf.document_frequency(vectors)
    return materialize(tfidf.inverse_document_frequency(found, vectors.count()), "idf")


def term_idf(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_idf(_vectors(spark, folder)), "idf")


def unit_weights(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    weights = materialize(tfidf.tfidf_weights(vectors, _idf(vectors)), "weights")
    return _rounded(tfidf.unit_weights(weights), "weight")


def hashed_weights(spark: SparkSession, folder: str) -> DataFrame:
    entries = vector_entries(hashed_vectors(books(spark, folder)))
    return _rounded(entries.filter(F.col("weight") > 0), "weight")


def similarity_target(spark: SparkSession, folder: str) -> DataFrame:
    return target_book(books(spark, folder), similarity.TARGET)


def _similar(
    compare: Callable[[DataFrame], similarity.SimilarityReport],
    use: Callable[[similarity.SimilarityReport], DataFrame],
) -> Query:
    return lambda spark, folder: _rounded(use(compare(books(spark, folder))), "similarity")


def similarity_report(spark: SparkSession, folder: str) -> DataFrame:
    return similarity.hashed(books(spark, folder)).lines().select("section", "rank", "line")


def similarity_report_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "report")
    similarity.exact(books(spark, folder)).save(path)
    return lines(spark, path).withColumnRenamed("value", "line")


def similar_by_index(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(similarity.top_by_index(books(spark, folder)).top, "similarity")


# Edges from their index


def _expanded(network: influence.InfluenceNetwork, authors: list[str] | None = None) -> DataFrame:
    sources = None
    if authors:
        session = network.nodes.sparkSession
        sources = session.createDataFrame([(a,) for a in authors], "author_original STRING")
    return net.expand_edges(network.edge_index(), sources)


# Positions


def _positions(query: Query, label: str, order: Callable[[], list[Column]]) -> Query:
    return lambda spark, folder: with_position(materialize(query(spark, folder), label), order())


def _degree_positions(spark: SparkSession, folder: str) -> DataFrame:
    network = influence.network(books(spark, folder))
    sides = []
    for side, table in (("out", network.out_degree()), ("in", network.in_degree())):
        author, degree = table.columns
        found = with_position(materialize(table, "degrees"), [F.desc(degree), F.asc(author)])
        renamed = found.select(F.lit(side).alias("side"), F.col(author).alias("author"), "position")
        sides.append(renamed)
    return sides[0].unionByName(sides[1])


def _similar_positions(spark: SparkSession, folder: str) -> DataFrame:
    scores = similarity.hashed(books(spark, folder)).similarities
    return _rounded(with_position(scores, by_similarity()), "similarity")


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "word_count": words,
        "word_count_files": words_of_files,
        "word_count_split_sizes": words_by_split_size,
        "books_scan": books,
        "word_count_positions": _positions(words, "words", lambda: [F.asc("word")]),
        "books_per_year_positions": _positions(
            _of_metadata(meta.books_per_year), "years", lambda: [F.desc("release_year")]
        ),
        "books_per_language_positions": _positions(
            _of_metadata(meta.books_per_language),
            "languages",
            lambda: [F.desc("count"), F.asc("language")],
        ),
        "degree_positions": _degree_positions,
        "similar_positions": _similar_positions,
        "file_outcomes": book_files.outcomes,
        "file_failures": book_files.failures,
        "file_metadata": book_files.metadata,
        "file_term_frequency": book_files.terms,
        "file_word_count": book_files.words,
        "metadata": book_metadata,
        "metadata_csv": metadata_csv,
        "metadata_sample": metadata_sample,
        "dated_books": _of_metadata(meta.dated_books),
        "books_per_year": _of_metadata(meta.books_per_year),
        "books_per_language": _of_metadata(meta.books_per_language),
        "top_language": _of_metadata(meta.top_language),
        "titles": _of_metadata(meta.titles),
        "average_title_length": _of_metadata(average_title_length),
        "title_statistics": _of_metadata(title_statistics),
        "row_counts": row_counts,
        "authors": _network(lambda n: n.authors),
        "author_variants": _network(lambda n: n.variants()),
        "influence_edges_x5": _network(lambda n: n.edges()),
        "influence_edges_csv": edges_csv,
        "edges_of_author": _network(lambda n: n.edges_of("Writer 42")),
        "edge_index_x5": _network(lambda n: n.edge_index()),
        "edges_from_index_x5": _network(_expanded),
        "edges_of_authors_x5": _network(lambda n: _expanded(n, ["Writer 7", "Writer 42", "nobody"])),
        "degrees_csv": degrees_csv,
        "window_sweep": window_sweep,
        "out_degree_authors_x5": _network(lambda n: n.out_degree(distinct_authors=True)),
        "in_degree_authors_x5": _network(lambda n: n.in_degree(distinct_authors=True)),
        "main_content": main_content,
        "clean_text": cleaned,
        "tokens": tokens,
        "filtered_tokens": filtered_tokens,
        "term_frequency": term_frequency,
        "term_idf": term_idf,
        "tfidf_unit_weights": unit_weights,
        "hashed_unit_weights": hashed_weights,
        "similarity_target": similarity_target,
        "similar_exact_top5": _similar(similarity.exact, lambda s: s.top()),
        "similar_indexed_top5": similar_by_index,
        "similar_exact_all": _similar(similarity.exact, lambda s: s.ranked()),
        "similar_hashed_top5": _similar(similarity.hashed, lambda s: s.top()),
        "similar_hashed_all": _similar(similarity.hashed, lambda s: s.ranked()),
        "similarity_report": similarity_report,
        "similarity_report_files": similarity_report_files,
    }
    for x in net.WINDOWS:
        found[f"out_degree_x{x}"] = _network(lambda n, x=x: n.out_degree(x))
        found[f"in_degree_x{x}"] = _network(lambda n, x=x: n.in_degree(x))
        found[f"top_influential_x{x}"] = _network(lambda n, x=x: n.top_influential(x))
        found[f"top_influenced_x{x}"] = _network(lambda n, x=x: n.top_influenced(x))
    return found
