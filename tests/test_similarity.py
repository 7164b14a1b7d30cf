import math

import pytest
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import functions as F

from corpusloom.operators import similarity as op
from corpusloom.operators import tfidf
from corpusloom.plans import similarity as plan
from corpusloom.workspace import materialize

BOOKS = {
    "1.txt": "whale ship sea sea captain",
    "2.txt": "whale ship sea harbour",
    "3.txt": "love letter ball captain",
    "200.txt": "whale whale ship love",
    "5.txt": "",
    "6.txt": "the and of it",
    "7.txt": "unheard syllables",
    "8.txt": "whale whale ship love",
}


@pytest.fixture(scope="module")
def books(spark):
    return spark.createDataFrame(list(BOOKS.items()), "file_name STRING, text STRING")


def plain_cosines(target):
    words = {n: [w for w in t.split() if w not in ("the", "and", "of", "it")] for n, t in BOOKS.items()}
    df = {w: sum(w in ws for ws in words.values()) for ws in words.values() for w in ws}
    idf = {w: math.log((len(words) + 1) / (n + 1)) if n >= 2 else 0.0 for w, n in df.items()}

    def unit(name):
        weights = {w: words[name].count(w) * idf[w] for w in set(words[name])}
        length = math.sqrt(sum(x * x for x in weights.values()))
        return {w: x / length for w, x in weights.items()} if length else {}

    other = unit(target)
    return {
        n: sum(x * other.get(w, 0.0) for w, x in unit(n).items()) for n in words if n != target
    }


@pytest.mark.parametrize("compare", [plan.exact, plan.hashed])
@pytest.mark.parametrize("wanted", ["200.txt", "5.txt", "3.txt"])
def test_cosines_equal_the_definition(books, compare, wanted):
    found = {r["file_name"]: r["similarity"] for r in compare(books, wanted).similarities.collect()}
    assert found == pytest.approx(plain_cosines(wanted), abs=1e-12)
    assert all(-1e-12 <= s <= 1 + 1e-12 for s in found.values())


def test_a_copy_scores_one_and_empty_books_zero(books):
    found = {r["file_name"]: r["similarity"] for r in plan.exact(books).similarities.collect()}
    assert found["8.txt"] == pytest.approx(1.0)
    assert found["5.txt"] == found["6.txt"] == found["7.txt"] == 0.0


def test_frequent_terms_joined_apart_give_the_same_scores(books, monkeypatch):
    whole = {r["file_name"]: r["similarity"] for r in plan.exact(books).similarities.collect()}
    monkeypatch.setattr(op, "lookup_join", lambda *a: tfidf.lookup_join(*a, max_rows=3))
    parted = {r["file_name"]: r["similarity"] for r in plan.exact(books).similarities.collect()}
    assert parted == pytest.approx(whole)


def test_a_missing_target_falls_back_to_the_first_name(books):
    report = plan.exact(books, "none.txt")
    assert report.target == "1.txt"
    assert report.similarities.filter("file_name = '1.txt'").count() == 0


def test_top_and_report(books):
    report = plan.exact(books)
    top = [tuple(r) for r in report.top(2).collect()]
    assert [t[:2] for t in top] == [(1, "8.txt"), (2, "2.txt")]
    lines = [r["line"] for r in report.lines(2).collect()]
    scores = [f"{r['file_name']}: {r['similarity']:.6f}" for r in report.ranked().collect()]
    assert lines == [
        "Top 2 books similar to 200.txt:",
        "-" * 50,
        "1. 8.txt - similarity: 1.000000",
        f"2. 2.txt - similarity: {top[1][2]:.6f}",
        "",
        "",
        "All similarity scores:",
        "-" * 50,
        *scores,
    ]


def test_saved_report_reads_in_order(books, tmp_path):
    report = plan.hashed(books)
    report.save(str(tmp_path / "report"))
    parts = sorted((tmp_path / "report").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text.splitlines() == [r["line"] for r in report.lines().collect()]


def test_idf_and_unit_weights_equal_the_feature_transformers(spark, books):
    vectors = materialize(tfidf.term_vectors(books), "vectors")
    idf = materialize(
        tfidf.inverse_document_frequency(tfidf.document_frequency(vectors), vectors.count()), "idf"
    )
    weights = materialize(tfidf.tfidf_weights(vectors, idf), "weights")
    ours = {
        (r["file_name"], r["term"]): r["weight"] for r in tfidf.unit_weights(weights).collect()
    }

    tokens = tfidf.filtered_tokens(books)
    hashing = HashingTF(inputCol="filtered_tokens", outputCol="tf", numFeatures=65536)
    counted = hashing.transform(tokens)
    weighted = IDF(inputCol="tf", outputCol="w", minDocFreq=2).fit(counted).transform(counted)
    unit = Normalizer(inputCol="w", outputCol="u").transform(weighted)
    theirs = {r["file_name"]: r["u"] for r in unit.collect()}
    for (name, term), weight in ours.items():
        assert theirs[name][hashing.indexOf(term)] == pytest.approx(weight)
    kept = {n: sum(1 for x in v.values if x) for n, v in theirs.items()}
    assert sum(kept.values()) == len(ours)


def test_idf_of_a_rare_a_shared_and_a_common_term(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "term STRING, df BIGINT")
    found = {r["term"]: r["idf"] for r in tfidf.inverse_document_frequency(df, 3).collect()}
    assert found == {"a": 0.0, "b": pytest.approx(0.287682, abs=1e-6), "c": 0.0}


def test_a_book_without_text_scores_zero(spark):
    rows = [("a", "whale ship"), ("b", "whale ship"), ("c", None), ("d", "sea")]
    books = spark.createDataFrame(rows, "file_name STRING, text STRING")
    for compare in (plan.exact, plan.hashed):
        found = {r["file_name"]: r["similarity"] for r in compare(books, "a").similarities.collect()}
        assert found == {"b": pytest.approx(1.0), "c": 0.0, "d": 0.0}


@pytest.mark.parametrize("compare", [plan.exact, plan.hashed])
def test_no_books(spark, compare):
    none = spark.createDataFrame([], "file_name STRING, text STRING")
    report = compare(none)
    assert report.target is None
    assert report.similarities.dtypes == [("file_name", "string"), ("similarity", "double")]
    assert report.similarities.count() == report.top().count() == 0


def test_hashed_scores_of_books_without_a_common_term(spark):
    texts = [("a.txt", "whale ship"), ("b.txt", "whale ship"), ("c.txt", "moor heath"), ("d.txt", "")]
    found = plan.hashed(spark.createDataFrame(texts, "file_name STRING, text STRING"), "a.txt")
    scores = {r["file_name"]: r["similarity"] for r in found.similarities.collect()}
    assert scores == {"b.txt": pytest.approx(1), "c.txt": 0, "d.txt": 0}


def test_one_pass_tokens_equal_the_steps(books):
    cleaned = tfidf.cleaned(books).collect()
    assert {r["file_name"] for r in cleaned} == set(BOOKS)
    counts = tfidf.term_frequency(tfidf.term_vectors(books))
    assert counts.filter(F.col("file_name") == "1.txt").agg(F.sum("tf")).first()[0] == 5
