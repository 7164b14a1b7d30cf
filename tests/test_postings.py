import random

import pytest

from corpusloom.operators import similarity as op
from corpusloom.operators import tfidf
from corpusloom.operators.postings import posting_index, search
from corpusloom.plans import similarity as plan
from corpusloom.workspace import materialize


def vectors_of(spark, texts):
    books = spark.createDataFrame(list(texts.items()), "file_name STRING, text STRING")
    return materialize(tfidf.term_vectors(books), "term-vectors")


def corpus(seed, books=120):
    """Frequent and rare words, a third of the books one text, some empty."""
    rng = random.Random(seed)
    common = [f"common{chr(97 + i)}" for i in range(12)]
    rare = [f"rare{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    texts = {}
    for i in range(books):
        own = rng.choices(common, k=rng.randint(5, 40)) + rng.choices(rare, k=rng.randint(0, 12))
        texts[f"{i}.txt"] = " ".join(own) if i % 17 else ""
    for i in range(0, books, 3):
        texts[f"{i}.txt"] = texts["1.txt"]
    for i in range(2, books, 11):  # near copies
        texts[f"{i}.txt"] = texts["4.txt"] + " " + texts[f"{i}.txt"]
    return texts


def ranks(df):
    return [(r["rank"], r["file_name"], round(r["similarity"], 9)) for r in df.collect()]


def test_top_equals_all_scores(spark):
    vectors = vectors_of(spark, corpus(1))
    index = posting_index(vectors, parts=3, block=8)
    for target, n in (("1.txt", 60), ("4.txt", 1), ("7.txt", 5)):
        every = op.exact_similarity(vectors, target)
        assert ranks(search(index, target, n).top) == ranks(op.top_similar(every, n)), target


def test_close_books_leave_postings_unread(spark):
    texts = corpus(3)
    index = posting_index(vectors_of(spark, texts), parts=3, block=8)
    found = search(index, "4.txt", 3)
    assert 0 < found.read < found.total


def test_a_target_without_terms_and_few_books(spark):
    texts = {"a.txt": "", "b.txt": "whale ship", "c.txt": "whale ship", "d.txt": "the"}
    index = posting_index(vectors_of(spark, texts))
    assert ranks(search(index, "a.txt", 2).top) == [(1, "b.txt", 0.0), (2, "c.txt", 0.0)]
    assert ranks(search(index, "b.txt").top) == [(1, "c.txt", 1.0), (2, "a.txt", 0.0), (3, "d.txt", 0.0)]


def test_no_books(spark):
    books = spark.createDataFrame([], "file_name STRING, text STRING")
    assert plan.top_by_index(books).top.collect() == []


def test_pairs_are_written_once(spark):
    from pathlib import Path

    from corpusloom.workspace import shared_folder

    vectors = vectors_of(spark, corpus(1))
    pairs = tfidf.term_frequency(vectors).count()
    before = set(Path(shared_folder(spark)).glob("corpusloom-*"))
    index = posting_index(vectors, parts=3, block=8)
    found = search(index, "1.txt", 60)
    written = set(Path(shared_folder(spark)).glob("corpusloom-*")) - before
    assert found.total <= pairs
    long = [p.name for p in written if 2 * spark.read.parquet(str(p)).count() >= pairs]
    assert [name.split("-")[1] for name in long] == ["postings"]


def test_ranges_are_bounded(spark, monkeypatch):
    from corpusloom.operators import postings

    monkeypatch.setattr(postings, "PART_POSTINGS", 40)
    index = posting_index(vectors_of(spark, corpus(1)), block=8)
    sizes = [row["count"] for row in index.entries.groupBy("part").count().collect()]
    assert len(sizes) > 8 and max(sizes) <= 4 * 40
