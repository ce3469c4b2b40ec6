"""Byte-pair encoding and decoding with forced boundaries.

A pair of bytes that stands side by side in no token of the vocabulary can never
be merged across: between two such bytes every text is cut. What lies between
the cuts is encoded on its own and the ids are put together again. Pieces repeat
far more often than words, so each Python process keeps the ids of pieces it has
met, up to a fixed number.

A null text is an empty one: no ids, decoded as an empty text. Texts of any
length are encoded whole. Repeated rows give equal ids. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from itertools import chain

import regex
from pyspark.sql import Column

from farelake.llm.common import memo, per_text

_MOST_WORDS_KEPT = 1 << 19
_LONGEST_WORD_KEPT = 40
_MOST_PIECES_KEPT = 1 << 17
_SHORT = 64
#: A merge is its rank and, in the low bits, the id it makes; so the smallest comes first.
_ID_BITS = 32
_ID_MASK = (1 << _ID_BITS) - 1
_NO_MERGE = 1 << 62


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, and its byte.

    Printable Latin-1 stands for itself, the other bytes for letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Known(dict):
    """Ids of words met before; others are encoded when they are asked for."""

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.encode(word))
        if len(word) <= _LONGEST_WORD_KEPT:
            if len(self) >= _MOST_WORDS_KEPT:
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary file in the tokenizers library's format."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = {to_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {}
        for rank, (left, right) in enumerate(pairs):
            a, b = to_bytes(left), to_bytes(right)
            self.merges[vocab[a], vocab[b]] = rank << _ID_BITS | vocab[a + b]
        self.first = [vocab[bytes([b])] for b in range(256)]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.token = {i: t for t, i in vocab.items()} | {i: s.encode() for s, i in special.items()}
        joined = {(t[i], t[i + 1]) for t in vocab for i in range(len(t) - 1)}
        #: Pairs of bytes that force a boundary between them.
        self.forced = {(a, b) for a in range(256) for b in range(256)} - joined
        self.special_split = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        # Fixed pattern of this vocabulary's splitter into words.
        self.words = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ).findall
        self.pieces: dict[bytes, list[int]] = {}
        self.known = _Known(self._word)

    def _merged(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of lowest rank is merged until none is left."""
        ids = [self.first[b] for b in piece]
        return self._merged_short(ids) if len(ids) <= _SHORT else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        """One pair at a time; only the pairs next to it change."""
        rank = self.merges.get
        found = [rank(pair, _NO_MERGE) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == _NO_MERGE:
                break
            i = found.index(best)
            del found[i], ids[i]
            ids[i] = best & _ID_MASK
            if i:
                found[i - 1] = rank((ids[i - 1], ids[i]), _NO_MERGE)
            if i < len(found):
                found[i] = rank((ids[i], ids[i + 1]), _NO_MERGE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """All pairs of the lowest rank at once, so that long pieces take few rounds."""
        while len(ids) > 1:
            found = [self.merges.get(p, _NO_MERGE) for p in zip(ids, ids[1:])]
            best = min(found)
            if best == _NO_MERGE:
                break
            out, i = [], 0
            while i < len(ids):
                if i < len(found) and found[i] == best:
                    out.append(best & _ID_MASK)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _piece(self, piece: bytes) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > _MOST_PIECES_KEPT:
                self.pieces.clear()
            ids = self.pieces[piece] = self._merged(piece)
        return ids

    def _word(self, word: str) -> list[int]:
        data = word.encode("utf-8", "replace")
        pairs = zip(data, data[1:])
        if self.forced.isdisjoint(pairs):
            ids = self._merged(data)
        else:
            ids, start = [], 0
            for i in range(1, len(data)):
                if (data[i - 1], data[i]) in self.forced:
                    ids += self._piece(data[start:i])
                    start = i
            ids += self._piece(data[start:])
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        start, known = 0, self.known.__getitem__
        cuts = [(m.start(), m.end()) for m in self.special_split.finditer(text)]
        for left, right in [*cuts, (len(text), None)]:
            words = self.words(text[start:left] if cuts else text)
            ids.extend(chain.from_iterable(map(known, words)))
            if right is not None:
                ids.append(self.special[text[left:right]])
                start = right
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


def encoded(vocabulary: str) -> Callable[[Column], Column]:
    """Column function: ``ids`` of a text as an array."""

    def factory() -> Callable[[str | None], tuple]:
        codec = memo(f"bpe_{vocabulary}", lambda: Codec(vocabulary))
        return lambda text: (codec.encode(text or ""),)

    udf = per_text("ids array<int>", factory)
    return lambda text: udf(text).getField("ids")


def decoded(vocabulary: str) -> Callable[[Column], Column]:
    """Column function: the text of an array of ids."""

    def factory() -> Callable[[object], tuple]:
        codec = memo(f"bpe_{vocabulary}", lambda: Codec(vocabulary))
        return lambda ids: (codec.decode([] if ids is None else list(ids)),)

    udf = per_text("decoded string", factory)
    return lambda ids: udf(ids).getField("decoded")


def coded(vocabulary: str) -> Callable[[Column], Column]:
    """Column function: ``n_tokens``, ``ids``, and digests of the ids and of the text
    decoded from them."""

    def factory() -> Callable[[str | None], tuple]:
        codec = memo(f"bpe_{vocabulary}", lambda: Codec(vocabulary))

        def both(text: str | None) -> tuple:
            ids = codec.encode(text or "")
            return (len(ids), ids, *_digests(codec, ids))

        return both

    return per_text(f"n_tokens long, ids array<int>, {_DIGESTS}", factory)


def digests(vocabulary: str) -> Callable[[Column], Column]:
    """As :func:`coded` without the ids, which so are not carried only to be counted."""

    def factory() -> Callable[[str | None], tuple]:
        codec = memo(f"bpe_{vocabulary}", lambda: Codec(vocabulary))

        def both(text: str | None) -> tuple:
            ids = codec.encode(text or "")
            return (len(ids), *_digests(codec, ids))

        return both

    return per_text(f"n_tokens long, {_DIGESTS}", factory)


_DIGESTS = "ids_sha256 string, decoded_sha256 string"


def _digests(codec: Codec, ids: list[int]) -> tuple[str, str]:
    text = codec.decode(ids)
    return (
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(text.encode()).hexdigest(),
    )
