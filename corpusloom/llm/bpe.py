"""Byte-level BPE token ids inside tasks, as the ``tokenizers`` library gives them.

Common texts are encoded by ``tiktoken`` with ranks taken from the same vocabulary file,
several times faster and with equal ids: the two differ at most in how they class rare
characters, treat added tokens and take merges out of the order of ids. Texts with such
characters, added tokens or very long words, and vocabularies of another build, go to
``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Characters whose class has been the same in all versions of Unicode since 5.2.
COMMON_RANGES = (
    "\t\n\r\r ~\u00a1\u00ac\u00ae\u024f\u0400\u04ff\u2010\u2027\u2030\u205e"
    "\u3041\u3096\u30a1\u30fa\u4e00\u9fa5\uac00\ud7a3"
)
LONG_WORD = 1000


@lru_cache(maxsize=1)
def _common() -> np.ndarray:
    """For each character below U+10000, whether it is in one of the ranges."""
    found = np.zeros(1 << 16, bool)
    ends = [ord(c) for c in COMMON_RANGES]
    for first, last in zip(ends[::2], ends[1::2], strict=True):
        found[first : last + 1] = True
    return found


def longest_word(text: str) -> int:
    """Most characters between two places of plain white space."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    spaces = np.flatnonzero((codes == 32) | (codes == 10) | (codes == 9) | (codes == 13))
    return int(np.diff(spaces, prepend=-1, append=len(codes)).max()) - 1


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """``encode`` gives ids as bytes, 32 bits each, little-endian."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        before = settings.get("pre_tokenizer") or {}
        #: text is cut by PATTERN, and no further step changes it
        self.by_pattern = (
            settings.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
        )
        self.added = [t["content"] for t in settings.get("added_tokens", [])]
        self.fast = _by_rank(settings) if self.by_pattern else None

    @property
    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def is_common(self, text: str) -> bool:
        if not self.by_pattern or any(token in text for token in self.added):
            return False
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        return codes.max(initial=0) < 1 << 16 and bool(_common()[codes].all())

    def by_library(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def ids(self, text: str) -> list[int]:
        if self.fast and self.is_common(text) and longest_word(text) <= LONG_WORD:
            return self.fast.encode_ordinary(text)
        return self.by_library([text])[0]

    def encode(self, text: str) -> bytes:
        return packed(self.ids(text))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        return map(self.encode, texts)


def packed(ids: list[int]) -> bytes:
    found = array("I", ids)
    if found.itemsize == 4 and sys.byteorder == "little":
        return found.tobytes()
    return np.asarray(ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable bytes
    stand for themselves, all others for characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    found = {chr(b): b for b in plain}
    found.update({chr(256 + i): b for i, b in enumerate(others)})
    return found


def spelled(token: str) -> bytes:
    return bytes(map(byte_of_char().__getitem__, token))


def _by_rank(settings: dict):
    """The same vocabulary for ``tiktoken``; None unless ids are in the order of merges."""
    import tiktoken

    model = settings["model"]
    if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
        return None
    added = {t["content"] for t in settings.get("added_tokens", [])}
    ids = {t: i for t, i in model["vocab"].items() if t not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [ids.get(a + b) for a, b in pairs]
    if made != list(range(256, 256 + len(made))) or len(ids) != 256 + len(made):
        return None
    ranks = {spelled(t): i for t, i in ids.items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)
