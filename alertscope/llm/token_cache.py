"""Token ids of whole texts as little-endian unsigned 32-bit bytes.

The tokenizers used here treat runs between white space independently, so a
worker encodes each distinct piece once and joins the bytes of its pieces.
The vocabulary travels to the executors as text; nothing is trained.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer

from alertscope.llm.common import is_latin1

# One thread per task: the cores are Spark's to share out.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

# What a regular expression engine of the tokenizers library
# counts as white space (the Unicode property White_Space).
_SPACE = r"\t-\r \x85\xa0  -     　"
# A run of these letters ends for either tokenizer at these marks.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
_MARKS = r"[!\"#$%&()*+,./:;<=>?@\[\\\]^`{|}~-]"
_BYTE_LEVEL = re.compile(
    f" ?{_LETTERS}(?={_MARKS}|[ \n]|$)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_WORD_LEVEL = re.compile(f"{_LETTERS}(?={_MARKS}|[ \n]|$)|[^ \n]+")

#: Distinct pieces that a worker keeps; a full cache starts anew.
CACHE_PIECES = 600_000
#: Longer pieces are encoded without being kept.
LONGEST_KEPT = 64

_encoders: dict[tuple[type, int], PieceEncoder] = {}


def byte_level_pieces(text: str) -> list[str]:
    """Cut where the byte-level pre-tokenizer always cuts: before a space and
    its word, around other white space, and after letters before a mark."""
    return _BYTE_LEVEL.findall(text)


def word_level_pieces(text: str) -> list[str]:
    """Cut at spaces and line ends, which the word tokenizer drops, and after
    letters before a mark."""
    return _WORD_LEVEL.findall(text)


class PieceEncoder(dict):
    """piece → id bytes, filled on demand, a text's new pieces together."""

    def __init__(self, vocabulary: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_str(vocabulary)
        kind = self.tokenizer.pre_tokenizer.__class__.__name__
        self.pieces = byte_level_pieces if kind == "ByteLevel" else word_level_pieces
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encode pieces in one call: a special token between them cuts the text
        before all else, and its id tells their ids apart."""
        if len(self) + len(new) > CACHE_PIECES:
            self.clear()
        self.update(self._encoded(new))

    def _encoded(self, new: list[str]) -> Iterator[tuple[str, bytes]]:
        joined = self.special[0].join(new)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(ids == self.tokenizer.token_to_id(self.special[0])).tolist()
        data = ids.tobytes()
        for piece, start, end in zip(new, [0, *(c + 1 for c in cuts)], [*cuts, len(ids)], strict=True):
            yield piece, data[4 * start : 4 * end]

    def __missing__(self, piece: str) -> bytes:
        return self.ids(piece)

    def _cut(self, text: str) -> list[str] | None:
        """The pieces of a text; None if it has to be encoded whole."""
        if any(s in text for s in self.special):  # cuts before the pre-tokenizer does
            return None
        if self.lowers and is_latin1(text):  # no case there depends on what stands beside it
            lower = text.lower()
            if any(s in lower for s in self.special):  # plain text to the library, which looks for them in the raw text
                return None
            text = lower
        return self.pieces(text)

    def encode(self, text: str | None) -> bytes:
        """Id bytes of a whole text; null is empty."""
        if not text:
            return b""
        pieces = self._cut(text)
        if pieces is None:
            return self.ids(text)
        if self.special and (new := [p for p in set(pieces) if p not in self and len(p) <= LONGEST_KEPT]):
            self._learn(new)
        return b"".join(map(self.__getitem__, pieces))


class PieceCounter(PieceEncoder):
    """Numbers of ids alone: small numbers in place of id bytes, no bytes joined."""

    def __init__(self, vocabulary: str) -> None:
        super().__init__(vocabulary)
        self.known: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
        self.known.update((piece, len(ids) // 4) for piece, ids in self._encoded(new))

    def count(self, text: str | None) -> int:
        """Number of ids of a whole text; null has none."""
        if not text:
            return 0
        pieces = self._cut(text)
        if pieces is None:
            return len(self.ids(text)) // 4
        different = set(pieces)
        new = different.difference(self.known)
        if new and self.special and (short := [p for p in new if len(p) <= LONGEST_KEPT]):
            self._learn(short)
            new = different.difference(self.known)
        if not new:
            return sum(map(self.known.__getitem__, pieces))
        known = self.known
        return sum(known[p] if p in known else len(self.ids(p)) // 4 for p in pieces)


def _kept(kind: type, vocabulary: str):
    key = kind, hash(vocabulary)
    if key not in _encoders:
        if len(_encoders) > 1:
            _encoders.clear()
        _encoders[key] = kind(vocabulary)
    return _encoders[key]


def encoder(vocabulary: str) -> PieceEncoder:
    """This worker's encoder of a vocabulary, kept between tasks; two at most,
    counters included."""
    return _kept(PieceEncoder, vocabulary)


def counter(vocabulary: str) -> PieceCounter:
    """This worker's counter of a vocabulary, kept like an encoder."""
    return _kept(PieceCounter, vocabulary)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
