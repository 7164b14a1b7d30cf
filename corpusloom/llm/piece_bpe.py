"""SentencePiece ids of merge-type vocabularies by a score-ordered agenda.

A text is normalised as the model says and its symbols start as single characters. All
neighbours whose concatenation is a piece stand on an agenda, highest score first and
leftmost among equals; taking an entry merges its two symbols and puts the new
neighbours on it. What is left and no piece is spelled in byte pieces.

Merges never cross a place where no piece has the two characters next to each other, so
a text is cut at such places beforehand: before a run of word marks, and around ASCII
characters that stand in no longer piece. The parts recur, so each worker keeps the ids
of those it has seen. Every part that enters that memory is checked: the parts new in an
Arrow batch go to the ``sentencepiece`` library together, and its ids stand where they
differ (``corrected`` counts them).
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.bpe import packed
from corpusloom.llm.common import id_and_text, ship_package

MARK = "▁"

# Parts kept by one worker, and the longest that are: they bound its memory, and only
# decide which parts are encoded again.
KEPT_PARTS = 1 << 19
KEPT_LENGTH = 64

# Rows encoded and handed over together.
ROWS = 128


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary_size(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


class PieceEncoder:
    """``encode_all`` gives ids as bytes, 32 bits each, little-endian."""

    def __init__(self, path: str, kept_parts: int = KEPT_PARTS) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kept_parts = kept_parts
        self.corrected = 0
        self.known: dict[str, bytes] = {}
        model = self.library
        scores: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.of_byte: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.of_byte[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scores[piece], self.id_of[piece] = model.get_score(i), i
        if any(s != int(s) for s in scores.values()) or len(self.of_byte) != 256:
            raise ValueError(f"{path} is no merge-type vocabulary with byte pieces")
        order = sorted(set(scores.values()), reverse=True)
        place = {score: i for i, score in enumerate(order)}
        #: pieces of equal score have equal ranks
        self.rank = {piece: place[score] for piece, score in scores.items()}
        self.in_order = ArrayAgenda(self.rank, self.id_of)
        self._prepare_cuts()

    def _prepare_cuts(self) -> None:
        joined = {c for p in self.rank if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        # a mark may follow other characters within a piece
        self.inside = any(MARK in p.lstrip(MARK) for p in self.rank)
        self.plain = not self.inside and "\n" not in joined
        if self.inside:
            self.parts = re.compile(f"[{alone}]|[^{alone}]+", re.S)
        else:
            self.parts = re.compile(f"{MARK}+[^{MARK}{alone}]*|[{alone}]|[^{MARK}{alone}]+", re.S)

    def cut(self, text: str) -> list[str]:
        text = self.library.normalize(text)
        if not self.plain or " " in text:
            return self.parts.findall(text)
        # faster; blanks, which the text has none of, part it, and runs of marks stay whole
        text = text.replace(MARK, f" {MARK}").replace("\n", " \n ")
        text = text.replace(f"{MARK} {MARK}", MARK * 2).replace(f"{MARK} {MARK}", MARK * 2)
        return text.split(" ")

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, without those of begin and end."""
        cut = list(map(self.cut, texts))
        if len(self.known) > self.kept_parts:
            self.known.clear()
        self.known[""] = b""
        known = self.known
        new = set(chain.from_iterable(cut)).difference(known)
        long = self._learn(list(new)) if new else {}
        if long:  # parts too long to be kept
            known = known | long
        return [b"".join(map(known.__getitem__, parts)) for parts in cut]

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        theirs = self._by_library(parts)
        ends = np.cumsum([4 * len(ids) for ids in theirs]).tolist()
        joined = packed(list(chain.from_iterable(theirs)))
        if self.agenda_all(parts) != joined:
            ours = map(packed, map(self.agenda, parts))
            self.corrected += sum(a != packed(b) for a, b in zip(ours, theirs, strict=True))
        long, begin = {}, 0
        for part, end in zip(parts, ends, strict=True):
            target = self.known if len(part) <= KEPT_LENGTH else long
            target[part] = joined[begin:end]
            begin = end
        return long

    def agenda_all(self, parts: list[str]) -> bytes:
        """Ids of all parts, one after the other."""
        short = [i for i, p in enumerate(parts) if len(p) <= KEPT_LENGTH]
        found: list[bytes | None] = [None] * len(parts)
        for i, ids in zip(short, self.in_order.merge([parts[i] for i in short]), strict=True):
            found[i] = ids
        # long ones, and those with characters to be spelled in bytes
        return b"".join(
            packed(self.agenda(p)) if ids is None else ids for p, ids in zip(parts, found, strict=True)
        )

    def _by_library(self, parts: list[str]) -> list[list[int]]:
        """The library's ids. It puts a mark before each text, so a part that begins with
        one loses it, and any other goes behind a newline, which no part runs across."""
        cut = [p.startswith(MARK) for p in parts]
        texts = [p[1:] if c else "\n" + p for p, c in zip(parts, cut, strict=True)]
        if not hasattr(self, "before"):
            self.before = len(self.library.encode("\n"))
        found = self.library.encode(texts, num_threads=1)
        # a lone mark is an empty text to the library, and has no ids there
        lone = [self.id_of[MARK]] if MARK in self.id_of else None
        return [
            (lone if not t else ids) if c else ids[self.before :]
            for t, ids, c in zip(texts, found, cut, strict=True)
        ]

    def agenda(self, part: str) -> list[int]:
        """Ids of one part by merging the neighbours of the highest score first.

        An entry is the rank of the pair's score and the place of its left symbol in one
        number; ``due`` has the entry that holds for each place, so that one whose
        symbols have changed since is passed over.
        """
        rank, n = self.rank, len(part)
        symbols = list(part)
        due = [-1] * n
        entries = []
        for i, pair in enumerate(map(add, symbols, symbols[1:])):
            if pair in rank:
                due[i] = rank[pair] * n + i
                entries.append(due[i])
        heapify(entries)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        while entries:
            entry = heappop(entries)
            i = entry % n
            if due[i] != entry:
                continue
            j = right[i]
            after = right[i] = right[j]
            symbols[i], symbols[j] = symbols[i] + symbols[j], ""
            due[i] = due[j] = -1
            if after < n:
                left[after] = i
                pair = symbols[i] + symbols[after]
                if pair in rank:
                    due[i] = rank[pair] * n + i
                    heappush(entries, due[i])
            before = left[i]
            if before >= 0:
                pair = symbols[before] + symbols[i]
                due[before] = -1
                if pair in rank:
                    due[before] = rank[pair] * n + before
                    heappush(entries, due[before])
        ids: list[int] = []
        for symbol in filter(None, symbols):
            if symbol in self.id_of:
                ids.append(self.id_of[symbol])
            else:
                ids.extend(map(self.of_byte.__getitem__, symbol.encode()))
        return ids

    def decode_all(self, found: list[bytes]) -> list[str]:
        return self.library.decode([np.frombuffer(x, "<u4").tolist() for x in found], num_threads=1)


class ArrayAgenda:
    """The agendas of many short parts at once: each round takes the first entry of every
    part, so a batch needs as many rounds as its longest part has merges."""

    NONE = np.int64(1) << 30

    def __init__(self, rank: dict[str, int], id_of: dict[str, int]) -> None:
        symbols = sorted(set(rank) | {c for p in rank for c in p})
        number = {symbol: i for i, symbol in enumerate(symbols)}
        self.size = len(symbols) + 1  # the last one stands for all other characters
        self.id_of = np.array([id_of.get(s, -1) for s in symbols] + [-1])
        self.of_char = np.full(sys.maxunicode + 1, len(symbols), np.int64)
        for symbol, i in number.items():
            if len(symbol) == 1:
                self.of_char[ord(symbol)] = i
        pairs = sorted(
            (number[p[:k]] * self.size + number[p[k:]], rank[p], number[p])
            for p in rank
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        )
        self.keys, ranks, self.joined = np.array(pairs, np.int64).reshape(-1, 3).T.copy()
        self.ranks = np.append(ranks, self.NONE)

    def _entries(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair among the keys, or one behind them."""
        key = left * self.size + right
        found = np.searchsorted(self.keys, key)
        found[found == len(self.keys)] = 0
        if not len(self.keys):
            return found
        return np.where(self.keys[found] == key, found, len(self.keys))

    def merge(self, parts: list[str]) -> list[bytes | None]:
        """Ids of each part; None if a character or symbol is no piece."""
        found: list[bytes | None] = [None] * len(parts)
        if not parts:
            return found
        lengths = np.array([len(p) for p in parts])
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        symbol, part = self.of_char[codes], np.repeat(np.arange(len(parts)), lengths)
        entry = np.full(len(symbol), len(self.keys))
        inner = np.flatnonzero(part[1:] == part[:-1])
        entry[inner] = self._entries(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            agenda = (self.ranks[entry] << 32) | np.arange(len(symbol))
            best = np.minimum.reduceat(agenda, first)
            done = best >> 32 == self.NONE
            if done.any():
                self._finish(found, symbol, part, first, done)
                keep = np.repeat(~done, np.diff(first, append=len(symbol)))
                best = (best & 0xFFFFFFFF)[~done]
                best = np.cumsum(keep)[best] - 1
                symbol, part, entry = symbol[keep], part[keep], entry[keep]
            else:
                best &= 0xFFFFFFFF
            if not len(symbol):
                break
            symbol[best] = self.joined[entry[best]]
            keep = np.ones(len(symbol), bool)
            keep[best + 1] = False
            best -= np.arange(len(best))  # one symbol went in each part before
            symbol, part, entry = symbol[keep], part[keep], entry[keep]
            for left in (best, best - 1):
                entry[left[left >= 0]] = len(self.keys)
                left = left[(left >= 0) & (left + 1 < len(symbol))]
                left = left[part[left] == part[left + 1]]
                entry[left] = self._entries(symbol[left], symbol[left + 1])
        return found

    def _finish(self, found, symbol, part, first, done) -> None:
        ids = self.id_of[symbol]
        ends = np.append(first[1:], len(symbol))
        spelled = np.minimum.reduceat(ids, first) < 0
        data = ids.astype("<u4").tobytes()
        chosen = done & ~spelled
        rows = (part[first[chosen]], first[chosen] * 4, ends[chosen] * 4)
        for i, a, b in zip(*(x.tolist() for x in rows), strict=True):
            found[i] = data[a:b]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process and vocabulary."""
    return PieceEncoder(path)


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, digest: bool = False
) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of each row: its ids with those of begin and
    end, 32 bits each, and the text they decode to. With ``digest`` both as SHA-256:
    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``.

    A null or empty text has the ids of begin and end and decodes to ''. Rows are encoded
    one by one: repeated rows give repeated results, a null identifier stays null, and no
    other column is read. A text of any length is encoded whole, in memory linear in it.
    An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    names = ["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]
    schema = f"doc_id BIGINT, n_tokens BIGINT, {names[0]} {'STRING' if digest else 'BINARY'}, {names[1]} STRING"
    kinds = [pa.int64(), pa.int64(), pa.string() if digest else pa.binary(), pa.string()]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_encoder(vocabulary)
        begin, end = packed([pieces.library.bos_id()]), packed([pieces.library.eos_id()])
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                some = batch.slice(i, ROWS)
                texts = some.column(1).to_pylist()
                ids = [begin + x + end for x in pieces.encode_all(texts)]
                counts = [len(x) // 4 for x in ids]
                decoded = pieces.decode_all(ids)
                if digest:
                    ids = [hashlib.sha256(x).hexdigest() for x in ids]
                    decoded = [hashlib.sha256(x.encode()).hexdigest() for x in decoded]
                columns = [some.column(0), *map(pa.array, (counts, ids, decoded), kinds[1:])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", *names])

    return id_and_text(docs).mapInArrow(encoded, schema)
