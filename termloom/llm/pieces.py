"""SentencePiece encoding by backtracking over longest matches, and decoding.

The encoding of a text is the one sequence of tokens in which every two neighbours, merged
anew from their characters, come out as just these two tokens. So it is found from left to
right: take the longest token that an Aho-Corasick automaton matches here and that agrees
with the token before; where none does, note the position as failed in a bitfield, drop the
last token and go on with the next shorter one. Every prefix has one encoding only, hence a
position that has failed once fails always.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches
from .cache import PieceCache, kept

SPACE = "▁"
CACHE_PAIRS = 500_000
LONG_TEXT = 1 << 20  # signs


class MergeEncoder:
    """Encodes like the library's model of merge type with byte fallback.

    Models with pieces that are user-defined, unused or lack bytes to fall back on are refused.
    """

    def __init__(self, path: str) -> None:
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are merged in another way")
        bytes_ = {sp.id_to_piece(i): i for i in ids if sp.is_byte(i)}
        if len(bytes_) != 256:
            raise ValueError("the model has no bytes to fall back on")
        self.bytes = [bytes_[f"<0x{b:02X}>"] for b in range(256)]
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.pieces = {
            i: sp.id_to_piece(i) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
        }
        self.ids = {p: i for i, p in self.pieces.items()}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        # the longest token that a token begins with, other than itself; -1 if there is none
        self.shorter = {
            i: next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1)
            for p, i in self.ids.items()
        }
        self.lengths = {i: len(p) for p, i in self.ids.items()}
        self.known = {p for p in self.ids if len(p) == 1}
        self.word = re.compile(self._words())
        self.cache = PieceCache(self._word)
        self.pairs: dict[int, bool] = {}

    def _words(self) -> str:
        """A pattern that cuts only between signs that stand side by side in no token."""
        sides = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        if any(s[1] == SPACE != s[0] for s in sides):
            return "(?s).+"
        letters = {s for s in self.known if s.isalpha() and s < "\u0250"}
        marks = {m for m in self.known if not m.isalnum() and m != SPACE and not any(s + m in sides for s in letters)}
        cut = f"{SPACE}*[{''.join(map(re.escape, sorted(letters)))}]++(?=[{''.join(map(re.escape, sorted(marks)))}])|"
        return (cut if marks else "") + f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"

    def merge(self, text: str) -> list[str]:
        """Tokens of a short text by merging: the best-scored pair first, the left one of equals."""
        symbols = list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = self.score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def agree(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side; ``left`` -1 is the start of the text."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        tokens = [self.pieces[right]] if left < 0 else [self.pieces[left], self.pieces[right]]
        found = self.pairs[left << 32 | right] = self.merge("".join(tokens)) == tokens
        return found

    def _run(self, text: str) -> list[int]:
        """Ids of a text of known signs."""
        n = len(text)
        longest = [0] * n
        for end, (length, token) in self.automaton.iter(text):
            longest[end + 1 - length] = token  # what ends later is longer
        lengths, shorter, pairs = self.lengths, self.shorter, self.pairs
        failed = bytearray((n >> 3) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            left = out[-1] if out else -1
            while token >= 0:
                to = at + lengths[token]
                if not failed[to >> 3] >> (to & 7) & 1:
                    fits = pairs.get(left << 32 | token)
                    if self.agree(left, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if to == n:
                    return out
                at, token = to, longest[to]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= lengths[last]
                token = shorter[last]

    def _word(self, word: str) -> bytes:
        ids: list[int] = []
        known = ""
        if self.known.issuperset(word):
            ids = self._run(word)
        else:
            for sign in [*word, ""]:
                if sign in self.known:
                    known += sign
                    continue
                if known:
                    ids += self._run(known)
                    known = ""
                ids += [self.bytes[b] for b in sign.encode()]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end; null is empty."""
        normal = self.library.normalize(text or "")
        if len(normal) <= LONG_TEXT:
            return self.cache.joined(self.word.findall(normal))
        return self.cache.joined_in_parts(m.group() for m in self.word.finditer(normal))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("merges", path), lambda: MergeEncoder(path))
        begin, end = (np.array([i], "<u4").tobytes() for i in (encoder.bos, encoder.eos))
        for batch in batches:
            rows = []
            for text in batch.column(1):
                ids = begin + encoder.encode(text.as_py()) + end
                decoded = encoder.decode(np.frombuffer(ids, "<u4").tolist())
                digests = [hashlib.sha256(x).hexdigest() for x in (ids, decoded.encode())]
                rows.append((len(ids) // 4, *digests))
            n, coded, decoded = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``.

    Ids are those of the whole text with begin and end; the decoded text is what the model
    makes of them again. A null text is empty. Equal texts get equal results; repeated and
    null ids change nothing. An empty table gives an empty table; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_digests(model_path), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
