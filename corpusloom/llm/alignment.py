"""Alignment of two tokenizers: which ids of a byte-level BPE (A) stand where which ids of
a merge-type SentencePiece vocabulary (B) stand, over a corpus.

Both encode a text, A with the space before it that B adds. Byte offsets where a token of
A and one of B both end cut the text into groups; tokens whose bytes overlap are linked.
Most groups are one token of A and the token of B with the same bytes. An array made
beforehand maps each id of A to that id of B, so that these links are counted in a vector
as long as the vocabulary. Only the other links enter a table of pairs and its shuffle,
added up in each batch of texts first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import bpe, piece_bpe
from corpusloom.llm.common import id_and_text, ship_package
from corpusloom.workspace import materialize

# Texts encoded together, and the links after which a batch ends. They bound memory and
# decide how far pairs are added up before the shuffle, not what is counted.
ROWS = 128
BATCH_LINKS = 1 << 21

ENCODED = (
    "batch BIGINT, regular ARRAY<BIGINT>, regular_links ARRAY<BIGINT>, pairs ARRAY<BIGINT>, "
    "pair_links ARRAY<BIGINT>, doc_id ARRAY<BIGINT>, n_a ARRAY<BIGINT>, n_b ARRAY<BIGINT>, "
    "n_groups ARRAY<BIGINT>, n_links ARRAY<BIGINT>, groups_sha256 ARRAY<STRING>, "
    "held BINARY"
)
DOCUMENTS = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, "
    "count_sum BIGINT, groups_sha256 STRING"
)


class TokenPair:
    """Both tokenizers, the bytes of their tokens and the map of equal ones."""

    def __init__(self, path_a: str, path_b: str) -> None:
        # an encoder of its own, since this one takes special tokens as plain text
        self.a = bpe.Encoder(path_a)
        if not self.a.by_pattern:
            raise ValueError(f"{path_a} is no byte-level vocabulary without further steps")
        self.a.tokenizer.encode_special_tokens = True
        special, self.a.added = set(self.a.added), []
        self.b = piece_bpe.piece_encoder(path_b)
        tokens = [self.a.tokenizer.id_to_token(i) for i in range(self.a.vocabulary_size)]
        self.bytes_a = [
            t.encode() if t in special else bpe.spelled(t) if t else b"" for t in tokens
        ]
        model = self.b.library
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(piece_bpe.MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.size_b = len(pieces)
        of_bytes = {x: self.b.id_of[p] for x, p in zip(self.bytes_b, pieces, strict=True) if p in self.b.id_of}
        #: the id of B with the same bytes, or -1
        self.same = np.array([of_bytes.get(x, -1) for x in self.bytes_a])
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        # decimals with the mark that follows, inside a list and at its end
        self.names_a = _decimals(len(self.bytes_a), ",", "|")
        self.names_b = _decimals(self.size_b, ",", ";")

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B; none where the bytes of either differ from the text's."""
        found_b = self.b.encode_all(texts)
        ids_a, ids_b = [], []
        for text, packed_b in zip(texts, found_b, strict=True):
            own = f" {text}".encode()
            a = self.a.ids(f" {text}") if text else []
            b = np.frombuffer(packed_b, "<u4")
            whole = (
                b"".join(map(self.bytes_a.__getitem__, a)) == own
                and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == own
            )
            ids_a.append(np.array(a if whole else [], np.int64))
            ids_b.append(b.astype(np.int64) if whole else np.array([], np.int64))
        return ids_a, ids_b


@lru_cache(maxsize=2)
def token_pair(path_a: str, path_b: str) -> TokenPair:
    """One for each worker process and pair of vocabularies."""
    return TokenPair(path_a, path_b)


def _decimals(size: int, inside: str, end: str) -> np.ndarray:
    """Each number, padded with zero bytes: at 2n followed by ``inside``, at 2n + 1 by
    ``end``."""
    names = [f"{i // 2}{end if i % 2 else inside}" for i in range(2 * size)]
    return np.array(names, "S")


@dataclass
class _Links:
    """Links and groups of some texts, as arrays."""

    a: np.ndarray  # id of A by link
    b: np.ndarray
    regular: np.ndarray  # whether the link is a group of its own, with equal bytes
    ends: np.ndarray  # where the links of each text end
    groups: list[int]
    digests: list[str]


def _linked(both: TokenPair, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> _Links:
    """Every segment between neighbouring ends of tokens lies in one token of A and one of
    B, and two tokens that overlap share one segment: segments are the links."""
    counts_a, counts_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
    a, b = np.concatenate(ids_a), np.concatenate(ids_b)
    ends_a, ends_b = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
    mark = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
    mark[ends_a] = 1
    mark[ends_b] |= 2
    kind = mark[np.flatnonzero(mark)].astype(np.int64)
    place_a = np.cumsum(kind & 1) - (kind & 1)
    place_b = np.cumsum(kind >> 1) - (kind >> 1)
    last = np.flatnonzero(kind == 3)  # the last link of each group
    links = np.diff(last, prepend=-1)
    # each text ends with a group, so no link crosses from one to the next
    link_ends = np.searchsorted(place_a, np.cumsum(counts_a))
    groups_upto = np.searchsorted(last, link_ends)
    alone = np.repeat(links == 1, links)
    link_a, link_b = a[place_a], b[place_b]
    regular = alone & (both.same[link_a] == link_b)

    # tokens in reading order: those of A in a group, then those of B
    end_a, end_b = place_a[last], place_b[last]
    group_a = np.searchsorted(end_a, np.arange(len(a)))
    group_b = np.searchsorted(end_b, np.arange(len(b)))
    names = np.empty(len(a) + len(b), np.result_type(both.names_a, both.names_b))
    final_a, final_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    final_a[end_a], final_b[end_b] = 1, 1
    before_b = np.append(0, end_b + 1)[:-1] if len(last) else np.array([], np.int64)
    names[np.arange(len(a)) + before_b[group_a]] = both.names_a[2 * a + final_a]
    names[np.arange(len(b)) + end_a[group_b] + 1] = both.names_b[2 * b + final_b]
    digests, begin = [], 0
    for end in np.cumsum(counts_a + counts_b).tolist():
        listed = names[begin:end].tobytes().translate(None, b"\0")[:-1]
        digests.append(hashlib.sha256(listed).hexdigest() if end > begin else "")
        begin = end
    groups = np.diff(groups_upto, prepend=0).tolist()
    return _Links(link_a, link_b, regular, link_ends, groups, digests)


def _multisets(codes: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Distinct codes below ``size`` of each text with their numbers, and where the
    codes of each text end."""
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    keys, counts = np.unique(text * max(size, 1) + codes, return_counts=True)
    return keys % max(size, 1), counts, np.searchsorted(keys // max(size, 1), np.arange(1, len(ends) + 1))


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Sizes and values of arrays of small numbers, 32 bits each."""
    parts = [np.array([len(arrays), *map(len, arrays)], "<u4"), *(x.astype("<u4") for x in arrays)]
    return b"".join(x.tobytes() for x in parts)


def _unpacked(data: bytes) -> list[np.ndarray]:
    values = np.frombuffer(data, "<u4").astype(np.int64)
    n = int(values[0])
    return np.split(values[1 + n :], np.cumsum(values[1 : 1 + n])[:-1])


class _Batch:
    def __init__(self, both: TokenPair) -> None:
        self.both, self.size = both, 0
        self.doc_id: list[int | None] = []
        self.n_a: list[int] = []
        self.n_b: list[int] = []
        self.found: list[_Links] = []

    def add(self, doc_ids: list[int | None], texts: list[str]) -> None:
        ids_a, ids_b = self.both.encode(texts)
        links = _linked(self.both, ids_a, ids_b)
        self.doc_id += doc_ids
        self.n_a += map(len, ids_a)
        self.n_b += map(len, ids_b)
        self.found.append(links)
        self.size += len(links.a)

    def row(self, number: int) -> dict:
        a = np.concatenate([x.a for x in self.found])
        b = np.concatenate([x.b for x in self.found])
        regular = np.concatenate([x.regular for x in self.found])
        sizes = np.concatenate([np.diff(x.ends, prepend=0) for x in self.found])
        ends = np.cumsum(sizes)
        size_b, same = self.both.size_b, self.both.same
        vector = np.bincount(a[regular], minlength=len(same))
        used = np.flatnonzero(vector)
        others = ~regular
        pairs, place, pair_links = np.unique(
            a[others] * size_b + b[others], return_inverse=True, return_counts=True
        )
        of_regular = np.append(0, np.cumsum(regular))[ends]
        held = [
            *_multisets(a[regular], of_regular, len(same)),
            *_multisets(place, ends - of_regular, len(pairs)),
        ]
        return {
            "batch": number,
            "regular": used * size_b + same[used],
            "regular_links": vector[used],
            "pairs": pairs,
            "pair_links": pair_links,
            "doc_id": self.doc_id,
            "n_a": self.n_a,
            "n_b": self.n_b,
            "n_groups": [n for x in self.found for n in x.groups],
            "n_links": sizes,
            "groups_sha256": [d for x in self.found for d in x.digests],
            "held": _packed(held),
        }


_LONGS = pa.list_(pa.int64())
_ENCODED = pa.schema(
    [("batch", pa.int64())]
    + [(n, _LONGS) for n in ("regular", "regular_links", "pairs", "pair_links", "doc_id")]
    + [(n, _LONGS) for n in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.list_(pa.string())), ("held", pa.binary())]
)


@dataclass(frozen=True)
class Alignment:
    """A written table of batches and one of scored pairs."""

    batches: DataFrame
    scored: DataFrame  # (pair, links, is_regular, is_best)
    size_b: int

    def pairs(self) -> DataFrame:
        """``(a_id, b_id, links, is_best)``: how often two ids are linked, and whether no
        other id of A is linked to that id of B more often."""
        code = F.col("pair")
        return self.scored.select(
            F.expr(f"pair div {self.size_b}").cast("int").alias("a_id"),
            (code % self.size_b).cast("int").alias("b_id"),
            "links",
            "is_best",
        )

    def documents(self) -> DataFrame:
        """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``."""
        # one row for each id of A at most
        rows = self.scored.filter("is_regular").select("pair", "links", "is_best").collect()
        of_regular = {r["pair"] // self.size_b: (r["links"], int(r["is_best"])) for r in rows}
        each = self.batches.select("batch", F.posexplode("pairs").alias("place", "pair"))
        entry = F.struct("place", "links", "is_best")
        of_batch = (
            each.join(self.scored, "pair")
            .groupBy(F.col("batch").alias("of_batch"))
            .agg(F.sort_array(F.collect_list(entry)).alias("found"))
        )
        joined = self.batches.join(of_batch, F.col("batch") == F.col("of_batch"), "left").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "held",
            F.col("found.links").alias("links"), F.col("found.is_best").alias("is_best"),
        )

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top = max(of_regular, default=-1) + 1
            regular = np.zeros((2, top), np.int64)
            for a, values in of_regular.items():
                regular[:, a] = values
            for batch in batches:
                for row in batch.to_pylist():
                    yield _document_rows(row, regular)

        return joined.mapInArrow(scored, DOCUMENTS)


def _document_rows(row: dict, regular: np.ndarray) -> pa.RecordBatch:
    ids, counts, ends, places, pair_counts, pair_ends = _unpacked(row["held"])
    irregular = np.array([row["links"] or [], row["is_best"] or []], np.int64).reshape(2, -1)

    def sums(values: np.ndarray, upto: np.ndarray) -> np.ndarray:
        running = np.append(0, np.cumsum(values))
        return np.diff(running[upto], prepend=0)

    count_sum, n_best = (
        sums(regular[k][ids] * counts, ends) + sums(irregular[k][places] * pair_counts, pair_ends)
        for k in (0, 1)
    )
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = {**row, "n_best": n_best, "count_sum": count_sum}
    kinds = [pa.int64()] * 7 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(found[n], k) for n, k in zip(names, kinds, strict=True)], names
    )


def align(
    docs: DataFrame,
    vocabulary_a: str | None = None,
    vocabulary_b: str | None = None,
    batch_links: int = BATCH_LINKS,
) -> Alignment:
    """Align both tokenizers over the texts of ``docs``.

    A null or empty text, and one whose bytes either tokenizer does not give back, has no
    tokens: its counts are 0 and its digest is ''. Repeated rows count each time and are
    returned each, a null identifier stays null, ties make several ids of A the best of
    one of B, other columns are not read, and an empty table gives empty tables. A text
    of any length is one unit of work, in memory linear in it.
    """
    ship_package(docs.sparkSession)
    path_a = vocabulary_a or bpe.default_vocabulary()
    path_b = vocabulary_b or piece_bpe.default_vocabulary()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = token_pair(path_a, path_b)
        # unique and the same when a task runs again
        number = TaskContext.get().partitionId() << 32
        held = _Batch(both)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                some = batch.slice(i, ROWS)
                held.add(some.column(0).to_pylist(), some.column(1).to_pylist())
                if held.size >= batch_links:
                    yield pa.RecordBatch.from_pylist([held.row(number)], _ENCODED)
                    number, held = number + 1, _Batch(both)
        if held.found:
            yield pa.RecordBatch.from_pylist([held.row(number)], _ENCODED)

    batches = materialize(id_and_text(docs).mapInArrow(encoded, ENCODED), "aligned")
    size_b = piece_bpe.vocabulary_size(path_b)

    def exploded(pairs: str, links: str, is_regular: bool) -> DataFrame:
        zipped = F.arrays_zip(F.col(pairs).alias("pair"), F.col(links).alias("links"))
        return batches.select(F.inline(zipped)).withColumn("is_regular", F.lit(is_regular))

    each = exploded("regular", "regular_links", True).unionByName(
        exploded("pairs", "pair_links", False)
    )
    totals = materialize(
        each.groupBy("pair").agg(F.sum("links").alias("links"), F.max("is_regular").alias("is_regular")),
        "pair-totals",
    ).withColumn("b", F.col("pair") % size_b)
    # one row for each id of B at most
    most = totals.groupBy("b").agg(F.max("links").alias("most"))
    scored = totals.join(F.broadcast(most), "b").select(
        "pair", "links", "is_regular", (F.col("links") == F.col("most")).alias("is_best")
    )
    return Alignment(batches, scored, size_b)
