from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import influence as op
from corpusloom.plans import influence as plan
from corpusloom.workspace import materialize

SCHEMA = "author_original STRING, author_norm STRING, release_year BIGINT"


def plain_edges(nodes, window):
    """Edges from the definition, over distinct (name, key, year)."""
    return {
        (a, b, y, z, z - y)
        for a, k, y in nodes
        for b, m, z in nodes
        if k != m and y <= z - window
    }


def skewed_nodes():
    """A third of the nodes share one key, another third one year."""
    nodes = {(f"Я{i}", "", 1900 + i % 40) for i in range(60)}
    nodes |= {(f"Writer {i}", f"writer {i}", 1950) for i in range(60)}
    nodes |= {(f"Poet {i % 20}", f"poet {i % 20}", 1800 + 7 * i) for i in range(60)}
    return nodes


def table(spark, nodes):
    return materialize(spark.createDataFrame(sorted(nodes), SCHEMA), "nodes")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("window", [1, 5, 20, 5000])
@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_edges_equal_the_definition(spark, window, block):
    nodes = skewed_nodes()
    found = rows(op.influence_edges(table(spark, nodes), window, block))
    assert len(found) == len(set(found))
    assert set(found) == plain_edges(nodes, window)


@pytest.mark.parametrize("window", [5, 5000])
def test_edge_index_is_linear_and_expands_to_all_edges(spark, window):
    nodes = skewed_nodes()
    index = materialize(op.edge_index(table(spark, nodes), window), "index")
    wanted = plain_edges(nodes, window)
    assert index.count() == len(nodes)
    assert index.agg(F.sum("out_edges")).first()[0] == len(wanted)
    for block in (1, 64) if window == 5 else (7,):
        found = rows(op.expand_edges(index, block_nodes=block))
        assert len(found) == len(set(found))
        assert set(found) == wanted


def test_edges_of_some_sources(spark):
    nodes = skewed_nodes()
    index = materialize(op.edge_index(table(spark, nodes), 5), "index")
    chosen = ["Poet 3", "Writer 7", "Writer 7", "nobody"]
    sources = spark.createDataFrame([(a,) for a in chosen], "author_original STRING")
    found = rows(op.expand_edges(index, sources, 7))
    assert len(found) == len(set(found))
    assert set(found) == {e for e in plain_edges(nodes, 5) if e[0] in chosen}


def test_edge_index_of_no_nodes(spark):
    index = materialize(op.edge_index(table(spark, set()), 5), "index")
    assert index.collect() == op.expand_edges(index).collect() == []


@pytest.mark.parametrize("author", ["Poet 3", "Writer 7", "nobody"])
def test_edges_of_one_author(spark, author):
    nodes = skewed_nodes()
    found = rows(op.edges_of(table(spark, nodes), author, 5))
    assert len(found) == len(set(found))
    assert set(found) == {e for e in plain_edges(nodes, 5) if author in e[:2]}


def test_degrees_equal_counted_edges(spark):
    nodes = skewed_nodes()
    points = op.book_years(table(spark, nodes))
    spans = op.author_spans(table(spark, nodes))
    for window in (1, 10):
        edges = plain_edges(nodes, window)
        assert dict(rows(op.out_degree(points, window))) == Counter(e[0] for e in edges)
        assert dict(rows(op.in_degree(points, window))) == Counter(e[1] for e in edges)
        pairs = {e[:2] for e in edges}
        assert dict(rows(op.out_degree(spans, window))) == Counter(a for a, _ in pairs)
        assert dict(rows(op.in_degree(spans, window))) == Counter(b for _, b in pairs)


def test_degrees_with_frequent_keys_joined_apart(spark, monkeypatch):
    nodes = skewed_nodes()
    points = op.book_years(table(spark, nodes))
    join = op.lookup_join
    monkeypatch.setattr(op, "lookup_join", lambda *a: join(*a, max_rows=5))
    edges = plain_edges(nodes, 5)
    assert dict(rows(op.out_degree(points, 5))) == Counter(e[0] for e in edges)
    assert dict(rows(op.in_degree(points, 5))) == Counter(e[1] for e in edges)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.sets(
        st.tuples(st.sampled_from("abAB ."), st.integers(1990, 2003)), min_size=1, max_size=25
    )
)
def test_network_properties(spark, drawn):
    nodes = {(name, name.lower().replace(".", ""), year) for name, year in drawn}
    points = op.book_years(table(spark, nodes))
    sweep = {w: n for w, n, _ in rows(op.window_sweep(points))}
    assert sweep == {w: len(plain_edges(nodes, w)) for w in op.WINDOWS}
    sizes = [sweep[w] for w in sorted(sweep)]
    assert sizes == sorted(sizes, reverse=True)
    for outward in (True, False):
        totals = op.degrees(points, op.WINDOWS, outward).agg(
            *[F.coalesce(F.sum(f"x{w}"), F.lit(0)) for w in op.WINDOWS]
        )
        assert rows(totals) == [tuple(sweep[w] for w in op.WINDOWS)]


def test_ratio_is_zero_without_edges(spark):
    points = op.book_years(table(spark, {("a", "a", 1900)}))
    assert rows(op.window_sweep(points)) == [(x, 0, 0.0) for x in op.WINDOWS]


def test_top_authors_break_ties_by_name_and_shorten_names(spark):
    long = "n" * 40
    degrees = spark.createDataFrame(
        [("b", 2), ("a", 2), (long, 9), ("c", 1)], "author_from STRING, out_degree BIGINT"
    )
    assert rows(op.top_authors(degrees, 3)) == [
        (1, long, "n" * 38 + "..", 9),
        (2, "a", "a", 2),
        (3, "b", "b", 2),
    ]


def test_authors_need_a_name_and_a_year(spark):
    texts = {
        "1": "Author: by Ann Lee (1835-1910),\nRelease Date: May 2001\n",
        "2": "Author: Ann LEE\nRelease Date: 0000\n",
        "3": "Author: Ann LEE\nRelease Date: never\n",
        "4": "Release Date: 2001\n",
        "5": "Author: ;\nRelease Date: 2001\n",
        "6": "Author: ann lee.\nRelease Date: 1999, 2001\n",
    }
    books = spark.createDataFrame(list(texts.items()), "file_name STRING, text STRING")
    found = op.authors(op.author_fields(books))
    assert sorted(rows(found)) == [
        ("1", "Ann Lee", 2001, "ann lee"),
        ("6", "ann lee", 1999, "ann lee"),
    ]
    assert rows(plan.network(books).edges(1)) == []


def test_long_name_lists_continue_on_further_rows(spark):
    written = ["Ж"] * 7 + ["Щ"] * 2 + ["Ю", "Э", "Я"]
    authors = spark.createDataFrame(
        [(str(i), n, 2000, "") for i, n in enumerate(written)] + [("x", "Al", 1999, "al")],
        "file_name STRING, author_original STRING, release_year BIGINT, author_norm STRING",
    )
    each = [("", 12, name, written.count(name)) for name in sorted(set(written))]
    assert rows(op.author_variants(authors)) == [*each, ("al", 1, "Al", 1)]


def test_saved_network(spark, tmp_path):
    texts = [
        (f"{i}.txt", f"Author: W{i % 3}\nRelease Date: {1900 + 4 * i}\n") for i in range(9)
    ]
    books = spark.createDataFrame(texts, "file_name STRING, text STRING")
    network = plan.network(books)
    network.save(str(tmp_path), edges=True)
    edges = spark.read.csv(f"{tmp_path}/edges")
    assert edges.count() == network.edges().count() > 0
    degrees = spark.read.schema("a STRING, n BIGINT").csv(f"{tmp_path}/out_degree")
    assert degrees.agg(F.sum("n")).first()[0] == edges.count()
    for window, (influential, influenced) in network.top_of_windows().items():
        assert rows(influential) == rows(network.top_influential(window))
        assert rows(influenced) == rows(network.top_influenced(window))
