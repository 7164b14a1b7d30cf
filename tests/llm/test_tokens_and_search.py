"""Piece encoding, alignment and lexical search against brute force: the library itself,
all pairs of overlapping tokens, and scores of all documents."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import alignment, bpe, piece_bpe, treap_search

SCHEMA = "doc_id BIGINT, text STRING, n_a INT, ids STRING, item STRING, score INT, pair INT"
LARGE = 2**60


def _texts():
    rng = random.Random(11)
    syllables = ["the", "nd", "ing", "ciónñ", "é", "ß", "llá", "er", "Qu", "ae"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(120)]
    odd = " ▁▁ab\n\t\r<>0x é漢字🙂​\0﻿.,;aaaa"
    texts = [None, "", " ", "  a  ", "a▁b", "x<|endoftext|>y</s><0x0A>", "漢字" * 400, "a" * 3000, " " * 500]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(40)]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randint(0, 50))) for _ in range(60)]
    return texts + [" ".join(rng.choice(words) for _ in range(20_000))]


TEXTS = _texts()
# large identifiers and none in one batch, a repeated row, a repeated identifier
ROWS = [(LARGE + 2 * i + 1, t) for i, t in enumerate(TEXTS)]
ROWS += [(None, TEXTS[12]), (None, None), ROWS[12], (LARGE + 1, TEXTS[13])]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "x", "y", 2, 3) for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.default_vocabulary())


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


def test_pieces_equal_the_library(docs, library):
    wanted = []
    for doc_id, text in ROWS:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        wanted.append((doc_id, len(ids), bytes(np.array(ids, "<u4").tobytes()), library.decode(ids)))
    found = [(r[0], r[1], bytes(r[2]), r[3]) for r in piece_bpe.encode_documents(docs).collect()]
    assert _sorted(found) == _sorted(wanted)
    digests = [
        (i, n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for i, n, ids, t in wanted
    ]
    assert _sorted(piece_bpe.encode_documents(docs, digest=True).collect()) == _sorted(digests)


def test_pieces_come_from_the_agenda(library):
    pieces = piece_bpe.PieceEncoder(piece_bpe.default_vocabulary(), kept_parts=50)
    texts = [t or "" for t in TEXTS]
    found = pieces.encode_all(texts) + pieces.encode_all(texts)
    assert found == 2 * [np.array(x, "<u4").tobytes() for x in library.encode(texts)]
    assert pieces.corrected == 0
    parts = sorted({p for t in texts for p in pieces.cut(t)} - {""})
    assert pieces.agenda_all(parts) == b"".join(bpe.packed(pieces.agenda(p)) for p in parts)


def test_equal_scores_go_to_the_leftmost(library):
    # runs of marks have pieces of one score
    pieces = piece_bpe.piece_encoder(piece_bpe.default_vocabulary())
    for n in range(1, 40):
        assert pieces.agenda("▁" * (n + 1)) == library.encode(" " * n)


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(Exception):
        piece_bpe.PieceEncoder(str(tmp_path / "none.model"))


def _tokens(library):
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(bpe.default_vocabulary())
    a.encode_special_tokens = True
    spelled = [bpe.spelled(a.id_to_token(i)) if i != 50256 else b"" for i in range(50257)]

    def of_b(i):
        piece = library.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode()

    def both(text):
        own = f" {text}".encode()
        ids = a.encode(f" {text}", add_special_tokens=False).ids, library.encode(text)
        sizes = [[spelled[i] for i in ids[0]], [of_b(i) for i in ids[1]]]
        if not text or any(b"".join(x) != own for x in sizes):
            return None
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in sizes]
        return [list(zip(i, [0, *e], e)) for i, e in zip(ids, ends, strict=True)]

    return both


def test_alignment(docs, library):
    both, links, rows = _tokens(library), Counter(), []
    for doc_id, text in ROWS:
        found = both(text or "") if len(text or "") < 3000 else None
        if len(text or "") >= 3000:
            continue
        if not found:
            rows.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b = found
        own = [(x, y) for x, p, q in a for y, s, t in b if p < t and s < q]
        links.update(own)
        groups, begin = [], 0
        for end in sorted({e for *_, e in a} & {e for *_, e in b}):
            sides = [[str(i) for i, p, q in x if begin <= p and q <= end] for x in (a, b)]
            groups.append("|".join(",".join(s) for s in sides))
            begin = end
        rows.append((doc_id, len(a), len(b), len(groups), own, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    wanted = [
        (i, a, b, g, len(own), sum(links[x] == most[x[1]] for x in own), sum(links[x] for x in own), d)
        for i, a, b, g, own, d in rows
    ]
    short = docs.filter("text is null or length(text) < 3000")
    found = alignment.align(short, batch_links=300)
    assert _sorted(found.documents().collect()) == _sorted(wanted)
    assert {tuple(r) for r in found.pairs().collect()} == {
        (a, b, n, n == most[b]) for (a, b), n in links.items()
    }
    # batches change nothing, and a long text is one of them
    whole, cut = (alignment.align(docs, batch_links=n).documents().collect() for n in (1 << 21, 100))
    assert _sorted(whole) == _sorted(cut) and len(whole) == len(ROWS)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return Counter(
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")
    )


def _ranked(rows, items, k):
    documents = [(i, _terms(t)) for i, t in rows]
    n = sum(bool(t) for _, t in documents)
    total = sum(sum(t.values()) for _, t in documents)
    df = Counter(t for _, terms in documents for t in terms)
    for item_id, text in items:
        scores = []
        for doc_id, terms in documents:
            mean = 75 + (25 * sum(terms.values()) * n) // total
            score = sum(
                times
                * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * terms[t] // (1000 * terms[t] + 12 * mean))
                for t, times in _terms(text).items()
                if terms[t]
            )
            scores.append((-score, doc_id is None, doc_id or 0))
        for place, (score, unknown, doc_id) in enumerate(sorted(s for s in scores if s[0])[:k]):
            yield item_id, place + 1, None if unknown else doc_id, -score


@pytest.mark.parametrize("grid_terms", [150, 2500, 1 << 21])
def test_search(spark, docs, grid_terms):
    items = [(1, TEXTS[12]), (2, TEXTS[20][:40]), (2, TEXTS[21]), (None, "the THE é"), (3, None), (4, "zz qq"), (5, "漢字")]
    asked = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = treap_search.build_index(docs, grid_terms).search(asked, k=7).collect()
    assert _sorted(found) == _sorted(_ranked(ROWS, items, 7))


def test_search_in_passes(spark, docs, monkeypatch):
    monkeypatch.setattr(treap_search, "PASS_TERMS", 20)
    items = [(i, TEXTS[10 + i][:60]) for i in range(12)]
    asked = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = treap_search.build_index(docs).search(asked).collect()
    assert _sorted(found) == _sorted(_ranked(ROWS, items, 20))


def test_treap_opens_few_ranges():
    rng = random.Random(2)
    grid = treap_search._Grid()
    for i in range(2000):
        grid.add(i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(30)))
    grid.add(2000, "rare words of one text")
    row = grid.row()
    shape = len(row["doc_id"]), len(row["terms"])
    made = treap_search._treap(row["postings"], *shape, row["n_docs"], row["n_terms"])
    treap = treap_search.Treap(pa.array(row["doc_id"], pa.int64()), *made)
    opened = []
    halved = treap._halved
    treap._halved = lambda *a: opened.append(len(a[3])) or halved(*a)
    best = treap_search.Best(1)
    rows = np.array([row["terms"].index(t) for t in ("rare", "text", "a")])
    treap.search(rows, np.array([9000, 9000, 1]), best)
    assert best.ids.tolist() == [2000]
    assert sum(opened) < 100


def test_no_rows(spark, nothing):
    items = spark.createDataFrame([(1, "a")], "item_id BIGINT, text STRING")
    assert piece_bpe.encode_documents(nothing).count() == 0
    assert alignment.align(nothing).documents().count() == 0
    assert alignment.align(nothing).pairs().count() == 0
    assert treap_search.build_index(nothing).search(items).count() == 0
