"""The books most like one book, from an index that leaves most postings unread.

The index holds unit TF-IDF weights by term, heaviest first, in blocks of which the
largest weight is known, and by book the counts and the length that give the same
weights. Postings cross one shuffle and are written once. A search reads the blocks of some of
the target's terms, and then whole vectors of the few books that can still be among
the best.

Why no skipped book can enter. Let ``lower`` be the n-th best score of n books that
were scored whole, so at most the n-th best of all. Terms are taken in order of their
squared target weight by posting until the target's vector without them is shorter
than ``lower``. Vectors have length 1, so by Cauchy and Schwarz a book's score over
terms not taken is at most the target's length there times the book's own length left.
A block left out of a term taken adds at most target weight times its largest weight;
these are kept below what ``lower`` exceeds the rest by. A book in no block read is
thus below ``lower``, and one that was read is dropped only if its bound is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import tfidf
from corpusloom.operators.joins import lookup_join
from corpusloom.operators.similarity import TIE_DECIMALS, by_similarity, top_similar
from corpusloom.workspace import materialize, new_path

BLOCK = 128
# Postings of a range, which one task sorts.
PART_POSTINGS = 2_000_000
# Sums of doubles differ in their last bits; ranks are by scores cut to TIE_DECIMALS.
MARGIN = 10.0 ** (1 - TIE_DECIMALS)
# Where the search begins. Scores below it cost a second look, not a result.
FIRST_GUESS = 0.7
_LOCAL = 1 << 33


@dataclass(frozen=True)
class PostingIndex:
    """Written tables, used by any number of searches."""

    entries: DataFrame  # part, term, block, file_name, weight
    blocks: DataFrame  # part, term, block, n, max_weight
    vectors: DataFrame  # shelf, file_name, terms: array of (term, tf), length
    idf: DataFrame  # term, df, idf
    names: DataFrame  # file_name, those without any weight too


@dataclass(frozen=True)
class Found:
    top: DataFrame  # rank, file_name, similarity
    read: int  # postings in the blocks that were read, and entries of books scored whole
    total: int  # postings in all


def posting_index(vectors: DataFrame, parts: int | None = None, block: int = BLOCK) -> PostingIndex:
    """Index a written :func:`tfidf.term_vectors` table.

    Postings are dealt over ``parts`` ranges of (term, weight), so a term in all books
    falls into many; a range is a folder, and a search opens only those it needs. Books
    lie in the folder of the task that wrote them.
    """
    spark = vectors.sparkSession
    df = materialize(tfidf.document_frequency(vectors), "document-frequency")
    idf = materialize(tfidf.inverse_document_frequency(df, vectors.count()), "idf")
    if not parts:
        postings = df.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // PART_POSTINGS))

    # a book is one row, so its sum is whole before the shuffle
    square = F.col("weight") * F.col("weight")
    lengths = materialize(
        tfidf.tfidf_weights(vectors, idf)
        .groupBy("file_name")
        .agg(F.sqrt(F.sum(square)).alias("length"), F.lit(1).alias("books")),
        "lengths",
    )
    measured = lookup_join(vectors, lengths, ["file_name"], "books")
    shelved = measured.select("file_name", "terms", "length", _task(parts).alias("shelf"))
    shelves = _by_folder(shelved, "shelf", "vectors")

    order = [F.asc("term"), F.desc("weight"), F.asc("file_name")]
    number = F.monotonically_increasing_id() % _LOCAL
    pairs = shelves.select("file_name", "length", F.inline("terms"))
    weighted = lookup_join(pairs, idf.filter(F.col("idf") > 0), ["term"], "df")
    unit = weighted.select("term", _weight().alias("weight"), "file_name")
    placed = (
        unit.repartitionByRange(parts, *order)
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions("part", *order)
        .select("term", F.floor(number / block).alias("block"), "file_name", "weight", "part")
    )
    entries = _by_folder(placed, "part", "postings")
    blocks = entries.groupBy("part", "term", "block").agg(
        F.count("*").alias("n"), F.max("weight").alias("max_weight")
    )
    names = materialize(vectors.select("file_name"), "names")
    return PostingIndex(entries, materialize(blocks, "posting-blocks"), shelves, idf, names)


def search(index: PostingIndex, target: str, n: int = 5) -> Found:
    """The ``n`` books most like ``target``, as :func:`exact_similarity` ranks them."""
    query = materialize(_target_vector(index, target), "target-vector")
    blocks = materialize(index.blocks.join(F.broadcast(query), "term"), "target-blocks")
    total = index.blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    terms = materialize(_terms_in_order(blocks), "target-terms")

    seen, read, _ = _read(index, blocks, terms, target, FIRST_GUESS, 0.0)
    best = seen.orderBy(F.desc("partial"), "file_name").limit(n).select("file_name")
    scored, more = _score(index, materialize(best, "first-books"), query)
    read += more
    worst = scored.agg(F.count("*"), F.min("similarity")).first()
    lower = worst[1] - MARGIN if worst[0] == n and worst[1] > MARGIN else 0.0

    if lower < FIRST_GUESS:
        seen, again, skipped = _read(index, blocks, terms, target, lower, lower)
        read += again
    else:
        skipped = 0.0
    rest = _rest_length(terms, min(lower, FIRST_GUESS))
    free = F.sqrt(F.greatest(1.0 - F.col("squares"), F.lit(0.0)))
    bound = F.col("partial") + F.lit(rest) * free + F.lit(skipped)
    left = materialize(seen.filter(bound >= lower - MARGIN).select("file_name"), "books-left")
    scored, more = _score(index, left, query)
    top = scored
    if lower == 0.0:  # books that share nothing may be among the first
        others = index.names.filter(F.col("file_name") != target)
        first = others.join(scored.select("file_name"), "file_name", "left_anti")
        none = first.orderBy("file_name").limit(n)
        top = scored.unionByName(none.select("file_name", F.lit(0.0).alias("similarity")))
    best = top.orderBy(*by_similarity()).limit(n)
    return Found(top_similar(best, n), read + more, total)


def _terms_in_order(blocks: DataFrame) -> DataFrame:
    """``(term, target_weight, left)``: ``left`` is the target's length over this term and
    all after it. The window sees the terms of one book."""
    terms = blocks.groupBy("term").agg(
        F.first("target_weight").alias("target_weight"), F.sum("n").alias("n")
    )
    square = F.col("target_weight") * F.col("target_weight")
    after = Window.orderBy(F.asc(square / F.col("n")), F.desc("term"))
    return terms.select("term", "target_weight", F.sqrt(F.sum(square).over(after)).alias("left"))


def _rest_length(terms: DataFrame, lower: float) -> float:
    """The target's length over the terms that :func:`_read` does not take."""
    rest = terms.filter(~_taken(lower))
    return rest.agg(F.coalesce(F.max("left"), F.lit(0.0))).first()[0]


def _taken(lower: float) -> Column:
    return F.col("left") >= lower - MARGIN


def _read(
    index: PostingIndex, blocks: DataFrame, terms: DataFrame, target: str, lower: float, spare: float
) -> tuple[DataFrame, int, float]:
    """``(file_name, partial, squares)`` of the books in the blocks read, how many
    postings these hold, and the most that blocks left out can add to a book.

    Blocks are left out only within what ``spare`` exceeds the rest by.
    """
    taken = terms.filter(_taken(lower)).select("term")
    slack = max(spare - 2 * MARGIN - _rest_length(terms, lower), 0.0) / 2
    small = F.lit(slack / max(taken.count(), 1))
    wanted = blocks.join(F.broadcast(taken), "term", "left_semi").filter(
        F.col("target_weight") * F.col("max_weight") > small
    )
    wanted = materialize(wanted, "wanted-blocks")
    parts = [row["part"] for row in wanted.select("part").distinct().collect()]
    read = wanted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    opened = index.entries.filter(F.col("part").isin(parts) & (F.col("file_name") != target))
    lookup = wanted.select("part", "term", "block", "n", "target_weight")
    met = lookup_join(opened, lookup, ["part", "term", "block"], "n")
    weight = F.col("weight")
    seen = met.groupBy("file_name").agg(
        F.sum(weight * F.col("target_weight")).alias("partial"),
        F.sum(weight * weight).alias("squares"),
    )
    return materialize(seen, "seen-books"), read, slack


def _target_vector(index: PostingIndex, target: str) -> DataFrame:
    """``(term, idf, target_weight)`` of one book."""
    own = index.vectors.filter(F.col("file_name") == target)
    pairs = own.select("length", F.inline("terms"))
    met = index.idf.filter(F.col("idf") > 0).join(F.broadcast(pairs), "term")
    return met.select("term", "idf", _weight().alias("target_weight"))


def _score(index: PostingIndex, names: DataFrame, query: DataFrame) -> tuple[DataFrame, int]:
    """``(file_name, similarity)`` from whole vectors, and how many entries these hold."""
    wanted = names.select("file_name")
    held = index.vectors.select("file_name", "shelf").join(wanted, "file_name", "left_semi")
    shelves = [row["shelf"] for row in held.select("shelf").distinct().collect()]
    opened = index.vectors.filter(F.col("shelf").isin(shelves))
    met = opened.select("file_name", "length", F.inline("terms")).join(
        F.broadcast(query), "term", "left"
    )
    scores = met.groupBy("file_name").agg(
        F.sum(_weight() * F.col("target_weight")).alias("similarity"), F.count("*").alias("entries")
    )
    # a book is one row, so it is summed where it lies and only then compared by name
    scores = materialize(scores.join(wanted, "file_name", "left_semi"), "scores")
    entries = scores.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0]
    return scores.filter("similarity is not null").select("file_name", "similarity"), entries


def _weight() -> Column:
    """The unit weight of a term in its book."""
    return F.col("tf") * F.col("idf") / F.col("length")


def _task(parts: int) -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(parts))


def _by_folder(df: DataFrame, folder: str, label: str) -> DataFrame:
    """Written with one folder for each value of the last column, an integer."""
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(folder).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
