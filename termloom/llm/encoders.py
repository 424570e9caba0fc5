"""Token ids by the tokenizers library, with a cache of the pieces of text between which it never merges."""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .cache import PieceCache, kept

#: white space of the library's patterns; letters, and marks that no token shares with a letter before them
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
_MARKS = r"!-&(-/:-@\[-`{-~"


@dataclass(frozen=True)
class Pieces:
    """Where a tokenizer surely cuts, and what it makes of letters before it merges."""

    pattern: str
    lower: bool


#: byte-level patterns cut before the space that leads a run of other signs, and between letters and marks
BYTE_LEVEL_PIECES = Pieces(f" ?[{_LETTERS}]++(?=[{_MARKS}])| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+", lower=False)
#: a tokenizer that drops white space and case never joins what stands around white space
WORD_PIECES = Pieces(rf"[{_LETTERS}]++(?=[{_MARKS}])|[^\t-\r ]+", lower=True)

#: bytes of a text that are cut up together
LONG_TEXT = 1 << 20
#: bytes of texts whose chunks are looked up together
TEXTS = 1 << 23
#: chunks in a generation of the cache
CHUNKS = 400_000

_SPACE = re.compile(rb"[\t-\r ]")
#: a space before white space: there a run of white space is more than the space that leads a word
_WHITE = rb"(?:[\t-\r ]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80)"
_RUN = re.compile(b" " + _WHITE)
#: after a space, a chunk that makes a run of it; and the bytes that such a chunk can begin with
_RUNS_ON = re.compile(_WHITE + rb"|\Z")
_RUN_STARTS = {b"", *(bytes([b]) for b in (*range(9, 14), 0xC2, 0xE1, 0xE2, 0xE3))}
_ENDS_WHITE = re.compile(rb".*" + _WHITE + rb"\Z", re.DOTALL)
_WHITE_ENDS = {bytes([b]) for b in (*range(9, 14), *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF)}
_MARK_BYTES = bytes(b for b in range(128) if re.match(f"[{_MARKS}]", chr(b)))
#: a word of letters, and marks that follow it
_WORD = re.compile(rb"([A-Za-z]*+(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][A-Za-z]*+)*+)([%s]*+)" % _MARKS.encode())


def _byte_signs() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, then from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class PieceEncoder:
    """Encodes texts piece by piece; the results are those for whole texts.

    With ``added_tokens``, the strings of the tokenizer's added tokens become their ids, as in the
    library's plain call; else they are ordinary text. Texts are cut at single spaces first;
    such chunks are looked up, and new ones are cut further. New pieces that are letters alone
    are one word, and go straight to the tokenizer's merges; all others take its whole way. Ids are
    kept in 16 bits if the vocabulary allows.
    """

    def __init__(self, path: str, pieces: Pieces, added_tokens: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # added tokens are cut out before there are pieces
        self.tokenizer.encode_special_tokens = True
        self.kind = "H" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "I"
        added = self.tokenizer.get_added_tokens_decoder() if added_tokens else {}
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("added tokens that depend on the signs around them, or on normalised text, are not known")
        self.added = {t.content.encode(): array(self.kind, [i]).tobytes() for i, t in added.items()}
        # the first one counts, and of those that begin there the longest
        self.at_added = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")")
        self.model = self.tokenizer.model
        self.lower = pieces.lower
        self.pieces = re.compile(pieces.pattern)
        self.one_word = re.compile(f" ?[{_LETTERS}]+")
        self.signs = _byte_signs()
        # chunks as they are, and those that a space leads (which is no part of the key)
        if self.lower:
            self.plain = PieceCache(lambda c: self._chunk(c.decode("utf-8", "replace")), CHUNKS)
        else:
            self.plain = PieceCache(lambda c: self._cut(c, "", self.plain), CHUNKS)
        self.space = self.signs[32]
        self.led = PieceCache(lambda c: self._cut(c, self.space, self.led), CHUNKS)

    def _merged(self, word: str) -> bytes:
        if self.lower:
            word = word.lower()
        signs = word.encode().decode("latin-1").translate(self.signs)
        return array(self.kind, [t.id for t in self.model.tokenize(signs)]).tobytes()

    def _new(self, piece: str) -> bytes:
        if self.one_word.fullmatch(piece):
            return self._merged(piece)
        return array(self.kind, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece[0] == " " and len(piece) > 1:
            return self.led[piece[1:].encode()]
        return self.plain[piece.encode()]

    def _chunk(self, text: str) -> bytes:
        pieces = self.pieces.findall(text)
        return self._new(text) if len(pieces) == 1 else b"".join(map(self._piece, pieces))

    def _cut(self, chunk: bytes, space: str, words: PieceCache) -> bytes:
        """The ids of a chunk that the space leads: most are words, which ``words`` keeps, and these with marks."""
        if chunk.isalpha():  # ASCII letters stand for themselves
            return array(self.kind, [t.id for t in self.model.tokenize(space + chunk.decode())]).tobytes()
        word = chunk.rstrip(_MARK_BYTES)
        if word.isalpha():
            return words[word] + self.plain[chunk[len(word) :]]
        text = (" " if space else "") + chunk.decode("utf-8", "replace")
        found = _WORD.fullmatch(chunk)
        if found and found[1]:
            return words[found[1]] + self.plain[found[2]] if found[2] else self._merged(text)
        return self._chunk(text)

    def ids(self, text: bytes | None) -> np.ndarray:
        """The ids of a text in UTF-8, in 16 or 32 bits; null is empty."""
        text = text or b""
        if any(token in text for token in self.added):
            out = b"".join(self.added.get(part) or self._ordinary(part) for part in self.at_added.split(text))
        else:
            out = self._ordinary(text)
        return np.frombuffer(out, "=u2" if self.kind == "H" else "=u4")

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.ids((text or "").encode()).astype("<u4").tobytes()

    def ids_of_all(self, texts: pa.BinaryArray) -> list[bytes]:
        """What ``ids`` gives for each text, as bytes; a chunk is looked up once for about ``TEXTS`` bytes of them."""
        out: list[bytes | None] = [None] * len(texts)
        places: list[int] = []
        size = 0
        for i, text in enumerate([] if self.lower else texts):
            text = text.as_py()
            if not text or len(text) > LONG_TEXT or any(token in text for token in self.added):
                continue
            if places and size + len(text) > TEXTS:
                self._together(texts.take(pa.array(places)), places, out)
                places, size = [], 0
            places.append(i)
            size += len(text)
        if places:
            self._together(texts.take(pa.array(places)), places, out)
        return [self.ids(texts[i].as_py()).tobytes() if x is None else x for i, x in enumerate(out)]

    def _together(self, texts: pa.BinaryArray, places: list[int], out: list[bytes | None]) -> None:
        """Puts the ids of the texts at their places, but leaves texts out that have runs of white space.

        A line end between other signs is a piece, and what follows it is like the beginning of a text.
        """
        in_text = pc.split_pattern(texts, b"\n")
        in_line = pc.split_pattern(in_text.values, b" ")
        lines, bounds = in_text.offsets.to_numpy().copy(), in_line.offsets.to_numpy().copy()
        chunks = in_line.values.dictionary_encode()
        del texts, in_text, in_line
        index, distinct = chunks.indices.to_numpy().copy(), chunks.dictionary.to_pylist()
        del chunks
        runs_on = np.array([c[:1] in _RUN_STARTS and bool(_RUNS_ON.match(c)) for c in distinct])
        white_end = np.array([c[-1:] in _WHITE_ENDS and bool(_ENDS_WHITE.match(c)) for c in distinct])
        begins = np.zeros(len(bounds) - 1, bool)  # lines with which a text begins
        begins[lines[:-1]] = True
        first, last = bounds[:-1], bounds[1:] - 1
        runs = runs_on.take(index)
        runs[first[begins]] = False
        runs[last] |= white_end.take(index[last]) & ~np.append(begins[1:], True)
        runs = np.logical_or.reduceat(runs, first[begins])
        # words are kept, what is made of them and marks is made anew for the next texts
        led, cut, space, line_end = self.led, self._cut, self.space, self.plain[b"\n"]
        ids = [
            b"" if r else cut(c, space, led) if c[-1] in _MARK_BYTES else led[c]
            for c, r in zip(distinct, runs_on, strict=True)
        ]
        kinds, index[first] = np.unique(2 * index[first].astype(np.int64) + begins, return_inverse=True)
        index[first] += len(distinct)
        ids += [self.plain[distinct[k >> 1]] if k & 1 else line_end + self.plain[distinct[k >> 1]] for k in kinds.tolist()]
        found = pa.array(ids, pa.binary()).take(pa.array(index))
        ends = np.frombuffer(found.buffers()[1], np.int32).take(bounds[lines])
        data = found.buffers()[2]
        for k, i in enumerate(places):
            if not runs[k]:
                out[i] = data[int(ends[k]) : int(ends[k + 1])].to_pybytes()
        # else the worker holds them until it ends
        del found, data
        pa.default_memory_pool().release_unused()

    def _ordinary(self, text: bytes) -> bytes:
        if len(text) <= LONG_TEXT:
            return self._slice(text)
        out, at = [], 0
        cut = _SPACE if self.lower else re.compile(rb"(?<![\t-\r ]) (?![\t-\r ])")
        while at < len(text):
            found = cut.search(text, at + LONG_TEXT)
            end = found.start() if found else len(text)
            out.append(self._slice(text[at:end]))
            at = end
        return b"".join(out)

    def _slice(self, text: bytes) -> bytes:
        if self.lower:
            return self.plain.joined(text.split())
        if _RUN.search(text):
            return b"".join(map(self._piece, self.pieces.findall(text.decode("utf-8", "replace"))))
        first, *rest = text.split(b" ")
        return self.plain[first] + self.led.joined(rest)


def kept_encoder(path: str, pieces: Pieces) -> PieceEncoder:
    """The worker's encoder for the library's plain call; its cache outlives a task."""
    return kept(("pieces", path, pieces.pattern, pieces.lower), lambda: PieceEncoder(path, pieces, added_tokens=True))
