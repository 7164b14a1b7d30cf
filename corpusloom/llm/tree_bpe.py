"""BPE of long texts by concatenating trees of encoded halves.

A text longer than a piece is cut anywhere, and the pieces are encoded as rows of their
own, in parallel. Neighbours are then joined pair by pair up to the whole text. At each
join a window of text around it is encoded anew, from a place where white space follows
something else on the left to such a place on the right. The window stands if what both
sides had for their part of it is what they end and begin with; otherwise it grows.

A run that the pre-tokenizer does not split is halved likewise, down to short leaves.
Joining two encoded halves, the ids next to the join are spelled out and encoded anew;
if the first new id is the left side's and the last one the right side's, every pair of
neighbours in the result is one that BPE makes, and so is the whole. Otherwise the
window doubles.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import (
    Encoder,
    default_vocabulary,
    encoder,
    longest_word,
    packed,
    spelled,
)
from corpusloom.llm.common import exact_ids, id_and_text, ship_package, whole_ids

PIECE = 16_384
LEAF = 1_024
NEAR = 256

_START = re.compile(r"(?<=[^ \n\t\r])[ \n\t\r]")


class TreeEncoder:
    def __init__(self, bpe: Encoder, leaf: int = LEAF) -> None:
        self.bpe, self.leaf = bpe, leaf
        self.bytes_of: dict[int, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; only runs longer than a leaf go through the tree."""
        if not self._has_run(text):
            return self.bpe.encode(text)
        cut = [span for _, span in self.bpe.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return b"".join(packed(self._run(text[a:b])) for a, b in cut)

    def _has_run(self, text: str) -> bool:
        return len(text) > self.leaf < longest_word(text) and self.bpe.is_common(text)

    def _run(self, run: str) -> list[int]:
        if len(run) <= self.leaf:
            return self.bpe.ids(run)
        half = len(run) // 2
        return self._join_run(self._run(run[:half]), self._run(run[half:]))

    def _join_run(self, left: list[int], right: list[int]) -> list[int]:
        size = 4
        while True:
            a, b = min(size, len(left)), min(size, len(right))
            around = b"".join(map(self._spelled, left[len(left) - a :] + right[:b]))
            try:
                window = self.bpe.ids(around.decode("utf-8"))
            except UnicodeDecodeError:  # it begins or ends inside a character
                size += 1
                continue
            agrees = (a == len(left) or window[0] == left[-a]) and (
                b == len(right) or window[-1] == right[b - 1]
            )
            if agrees and (len(window) > 1 or a == len(left) or b == len(right)):
                return left[: len(left) - a] + window + right[b:]
            size *= 2

    def _spelled(self, token_id: int) -> bytes:
        if token_id not in self.bytes_of:
            token = self.bpe.tokenizer.id_to_token(token_id)
            self.bytes_of[token_id] = spelled(token)
        return self.bytes_of[token_id]

    def join(self, left: tuple[str, bytes], right: tuple[str, bytes]) -> tuple[str, bytes]:
        """The text and ids of two neighbouring pieces put together."""
        text = left[0] + right[0]
        if not left[0] or not right[0]:
            return text, left[1] + right[1]
        if not self.bpe.is_common(text):
            return text, self.encode(text)
        near = NEAR
        while True:
            whole_left, whole_right = near >= len(left[0]), near >= len(right[0])
            begin = 0 if whole_left else _first_start(left[0], len(left[0]) - near)
            end = len(right[0]) if whole_right else _last_start(right[0], near)
            if begin is not None and end is not None:
                tail, head = left[0][begin:], right[0][:end]
                a, window, b = map(self.encode, (tail, tail + head, head))
                if left[1].endswith(a) and right[1].startswith(b):
                    return text, left[1][: len(left[1]) - len(a)] + window + right[1][len(b) :]
            near *= 2


def _first_start(text: str, begin: int) -> int | None:
    found = _START.search(text, begin)
    return found.start() if found else None


def _last_start(text: str, end: int) -> int | None:
    place = None
    for found in _START.finditer(text, 0, end):
        place = found.start()
    return place


RESULT = "doc_id BIGINT, n_tokens BIGINT, ids BINARY, decoded STRING"


def _decoded(bpe: Encoder, doc_ids: list, found: list[bytes]) -> pd.DataFrame:
    ids = [np.frombuffer(x, "<u4").tolist() for x in found]
    texts = bpe.tokenizer.decode_batch(ids, skip_special_tokens=False)
    frame = pd.DataFrame(
        {
            "doc_id": whole_ids(doc_ids),
            "n_tokens": [len(x) for x in ids],
            "ids": found,
            "decoded": pd.Series(texts, dtype=object),
        }
    )
    return frame


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, piece: int = PIECE, digest: bool = False
) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of each row: its ids, 32 bits each, and the
    text they decode to. With ``digest``, both as SHA-256 instead: ``(doc_id, n_tokens,
    ids_sha256, decoded_sha256)``, the ids as decimals joined by commas.

    A null or empty text has no ids and decodes to ''. Repeated rows and rows without an
    identifier are encoded one by one. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    rows = exact_ids(id_and_text(docs))
    finish = _digests if digest else _decoded
    schema = (
        "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
        if digest
        else RESULT
    )

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = TreeEncoder(encoder(vocabulary))
        for batch in batches:
            for i in range(0, len(batch), 128):
                some = batch.iloc[i : i + 128]
                yield finish(tree.bpe, whole_ids(some["doc_id"]), list(map(tree.encode, some["text"])))

    def encode_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = TreeEncoder(encoder(vocabulary))
        for batch in batches:
            for i in range(0, len(batch), 64):
                some = batch.iloc[i : i + 64]
                yield some.assign(ids=list(map(tree.encode, some["text"])))

    def join_pieces(held: pd.DataFrame) -> pd.DataFrame:
        tree = TreeEncoder(encoder(vocabulary))
        held = held.sort_values("number")
        level = list(zip(held["text"], held["ids"], strict=True))
        while len(level) > 1:
            pairs = [tree.join(*level[i : i + 2]) for i in range(0, len(level) - 1, 2)]
            level = pairs + level[2 * len(pairs) :]
        copies = int(held["copies"].iloc[0])
        doc_id = held["doc_id"].iloc[0]
        return finish(tree.bpe, [doc_id] * copies, [level[0][1]] * copies)

    long = F.length("text") > piece
    of_short = rows.filter(~long).mapInPandas(short, schema)
    # a row that repeats identifier and text is encoded once and given out as often
    pieces = (
        rows.filter(long)
        .withColumn("key", F.sha2("text", 256))
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.ceil(F.length("text") / piece).cast("int") - 1)))
        .withColumn("text", F.expr(f"substring(text, number * {piece} + 1, {piece})"))
        .groupBy("doc_id", "key", "number")
        .agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    )
    fields = "doc_id STRING, key STRING, number INT, text STRING, copies BIGINT, ids BINARY"
    encoded = pieces.mapInPandas(encode_pieces, fields)
    of_long = encoded.groupBy("doc_id", "key").applyInPandas(join_pieces, schema)
    return of_short.unionByName(of_long)


def _digests(bpe: Encoder, doc_ids: list, found: list[bytes]) -> pd.DataFrame:
    names = _decimals(bpe)
    frame = _decoded(bpe, doc_ids, found)
    listed = [
        hashlib.sha256(
            ",".join(map(names.__getitem__, np.frombuffer(x, "<u4").tolist())).encode()
        ).hexdigest()
        for x in found
    ]
    texts = [hashlib.sha256(t.encode()).hexdigest() for t in frame["decoded"]]
    return frame[["doc_id", "n_tokens"]].assign(ids_sha256=listed, decoded_sha256=texts)


def _decimals(bpe: Encoder) -> list[str]:
    if not hasattr(bpe, "decimals"):
        bpe.decimals = [str(i) for i in range(bpe.vocabulary_size)]
    return bpe.decimals
