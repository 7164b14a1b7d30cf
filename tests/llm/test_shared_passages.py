"""Documents that share passages, at sizes where some pairs are linked and others are not."""

import random

import numpy as np
import pytest

from corpusloom.llm import jaccard_join, suffix_dedup


def _documents():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]

    def prose(n):
        return [rng.choice(words) for _ in range(n)]

    passages = [prose(n) for n in (200, 150, 60)]
    texts = []
    for own in (10, 15, 20, 30, 45, 60, 200):  # from nearly all of a passage to half of it
        for passage in passages:
            texts += [passage + prose(own), prose(own // 2) + passage + prose(own // 2)]
    texts += [passages[0] + passages[1], passages[1] + passages[0], passages[2]]
    return [(i + 2**54, " ".join(t)) for i, t in enumerate(texts)]


DOCUMENTS = _documents()


def _links():
    sets = {}
    for doc_id, text in DOCUMENTS:
        words = text.split(" ")
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    found = set()
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                found.add((a, b))
    return found


@pytest.mark.parametrize("rounds", [1, jaccard_join.MAX_ROUNDS])
def test_components_equal_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard_join, "MAX_ROUNDS", rounds)
    first = {i: i for i, _ in DOCUMENTS}
    for a, b in sorted(_links()):
        low, high = sorted((first[a], first[b]))
        first = {i: low if f == high else f for i, f in first.items()}
    assert 1 < len(set(first.values())) < len(DOCUMENTS)
    docs = spark.createDataFrame(DOCUMENTS, "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}
    assert found == first


def test_lists_of_equal_members_are_one(spark):
    rows = [(h, i, 10) for h, ids in {1: (1, 2), 2: (2, 1), 3: (1, 2, 3), 4: (3, 1)}.items() for i in ids]
    lists = spark.createDataFrame(rows, "hash BIGINT, id BIGINT, n BIGINT")
    found = jaccard_join._weighted(lists).collect()
    held = {}
    for r in found:
        held.setdefault((r["hash"], r["weight"]), set()).add(r["id"])
    assert held == {(1, 2): {1, 2}, (3, 1): {1, 2, 3}, (4, 1): {1, 3}}


@pytest.mark.parametrize("symbols", [1, 2, 3, 200])
def test_induced_suffixes_are_sorted(symbols):
    rng = np.random.default_rng(symbols)
    for size in (1, 2, 7, 60):
        text = np.append(rng.integers(1, 1 + symbols, size), 0).astype("u1")
        raw = text.tobytes()
        wanted = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert suffix_dedup.suffix_array(text, len(text)).tolist() == wanted


def test_wide_bitmaps_rule_out_large_sets(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from corpusloom.llm import jaccard_join as j

    rng = np.random.default_rng(5)

    def row(found):
        wide = j._bitmap(found, j.WIDE_WORDS)
        narrow = j._bitmap(found, j.WORDS)
        assert (np.bitwise_xor.reduce(wide.reshape(-1, j.WORDS)) == narrow).all()
        return [len(found), *narrow.tolist(), wide.tolist()]

    one, other = (np.unique(rng.integers(0, 2**63, 4000, dtype="u8")) for _ in range(2))
    near = np.unique(np.concatenate([one[400:], other[:400]]))
    names = ["n", *j.BITMAP, "wide"]
    kinds = ["bigint"] * (1 + j.WORDS) + ["array<bigint>"]
    schema = ", ".join(f"{n}_{x} {k}" for x in "ab" for n, k in zip(names, kinds, strict=True))
    rows = [tuple(row(one) + row(x)) for x in (one, near, other)]
    pairs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    assert {r["i"] for r in pairs.filter(j._alike(80)).select("i").collect()} == {0, 1}
    # one of the two too small for a wide one: only the narrow bitmaps count
    none = pairs.withColumn("wide_b", F.lit(None).cast("array<bigint>"))
    assert none.filter(j._alike(80)).count() == 3


def _copied_rows():
    """Copies of whole texts, earlier and later than texts that share a part of them."""
    a, b, c = (DOCUMENTS[i][1] for i in (0, 6, 12))
    texts = [a, b, a, a + " end", "short", "short", "é" * 60, a, c, c, "x " + b, "é" * 60, b, ""]
    return [(3 * i + 2**54, t) for i, t in enumerate(texts)]


def _kept(rows):
    """Bytes removed, runs and bytes kept of each text, by sets of windows."""
    found, seen = {}, set()
    for doc_id, text in sorted(rows):
        raw = text.encode()
        windows = [raw[k : k + 50] for k in range(len(raw) - 49)]
        gone = {k + j for k, w in enumerate(windows) if w in seen for j in range(50)}
        seen.update(windows)
        kept = bytes(b for k, b in enumerate(raw) if k not in gone)
        found[doc_id] = (len(gone), sum(k - 1 not in gone for k in gone), kept)
    return found


def _removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = suffix_dedup.suffix_dedup(docs).collect()
    return [(r["doc_id"], (r["n_removed"], r["n_spans"], bytes(r["kept"]))) for r in found]


@pytest.mark.parametrize("most", [suffix_dedup.MAX_BROADCAST, 2])
def test_copies_of_a_text_are_not_compared(spark, monkeypatch, most):
    rows, written = _copied_rows(), {}

    def keep(df, label, write=suffix_dedup.materialize):
        written[label] = write(df, label)
        return written[label]

    monkeypatch.setattr(suffix_dedup, "materialize", keep)
    monkeypatch.setattr(suffix_dedup, "MAX_BROADCAST", most)
    assert dict(_removed(spark, rows)) == _kept(rows)
    first = {}
    for doc_id, text in rows:
        first.setdefault(text, doc_id)
    compared = {r["doc_id"] for r in written["occurrences"].select("doc_id").distinct().collect()}
    if most > len(rows):
        assert compared and compared <= set(first.values())
    else:  # some copies are, if there are too many
        assert compared < {i for i, _ in rows}


def test_a_context_is_written_once_in_a_batch(spark):
    passage = DOCUMENTS[0][1]
    docs = spark.createDataFrame([(1, passage + " a"), (2, passage + " b")], "doc_id BIGINT, text STRING")
    rows = docs.coalesce(1)
    found = suffix_dedup._occurrences(rows, suffix_dedup._shared_codes(rows)).collect()
    with_bytes = [(r["gram"], r["context_id"]) for r in found if r["context"] is not None]
    assert len(found) > 1.8 * len(with_bytes)
    assert sorted(with_bytes) == sorted({(r["gram"], r["context_id"]) for r in found})


def test_rows_that_repeat_an_identifier_count_as_before(spark):
    a, b = DOCUMENTS[0][1], DOCUMENTS[6][1]
    # a row with the text of an earlier one and another text under the same identifier
    rows = [(1, a), (2, a), (2, b), (3, b), (4, a), (4, a), (None, b)]
    found = sorted(_removed(spark, rows), key=str)
    size_a, size_b = len(a.encode()), len(b.encode())
    whole = {i: n for i, (n, _, _) in found if i in (3, 4)}
    assert whole == {3: size_b, 4: size_a}
    assert [kept for i, (_, _, kept) in found if i in (1, None)] == [a.encode(), b.encode()]


@pytest.mark.parametrize("most", [30, 11])
def test_filters_grow_with_the_texts(spark, monkeypatch, most):
    written = {}

    def keep(df, label, write=suffix_dedup.materialize):
        written[label] = write(df, label)
        return written[label]

    monkeypatch.setattr(suffix_dedup, "materialize", keep)
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", 11)
    monkeypatch.setattr(suffix_dedup, "MOST_BITS", most, raising=False)
    assert dict(_removed(spark, DOCUMENTS)) == _kept(DOCUMENTS)
    if most > 11:  # a full filter lets others pass, and the result is the same
        held = {}
        for r in written["occurrences"].select("gram", "doc_id").collect():
            held.setdefault(r["gram"], set()).add(r["doc_id"])
        alone = sum(len(ids) == 1 for ids in held.values())
        every = sum(len(suffix_dedup.anchors(suffix_dedup._bytes(t))[0]) for _, t in DOCUMENTS)
        assert 100 * alone < every


def test_filter_holds_what_was_put_in(spark):
    grams = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 20_000)
    shared = spark.createDataFrame([(int(g),) for g in grams[:2000]], "gram BIGINT")
    bits = suffix_dedup._filter(shared)
    parts = grams & ((1 << suffix_dedup.PIECE_BITS) - 1)
    found = suffix_dedup._held(bits, grams.view("u8"), parts, suffix_dedup.PIECE_BITS)
    assert found[:2000].tolist() == list(range(2000)) and len(found) == 2000
