"""Words of texts as 64-bit hashes, with numpy.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 20  # bytes hashed at once

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20_231).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    """Hashes of the words of byte strings; keeps its tables of powers."""

    def __init__(self) -> None:
        self.size = 0

    def _tables(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, SLICE + 4096)
            self.up, self.down = powers(_BASE, self.size), powers(_BASE_INVERSE, self.size)

    def of_slice(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the words of one slice that ends at a word's end."""
        b = np.frombuffer(data, np.uint8)
        self._tables(len(b))
        space = np.concatenate([[True], _SPACE[b], [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edges[0::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * self.up[: len(b)], dtype=np.uint64)])
        return starts, mix((sums[ends] - sums[starts]) * self.down[starts])

    def of_texts(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(position, word hashes) of each text, in order; null is empty.

        Short texts are hashed together, long ones in slices.
        """
        held: list[bytes] = []
        size = first = 0
        for i, text in enumerate(texts):
            data = (text or "").encode("utf-8", "surrogatepass").lower()
            if held and size + len(data) > SLICE:
                yield from self._together(first, held)
                held, size, first = [], 0, i
            held.append(data)
            size += len(data) + 1
        if held:
            yield from self._together(first, held)

    def _together(self, first: int, held: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        if len(held) == 1 and len(held[0]) > SLICE:
            yield first, np.concatenate([self.of_slice(s)[1] for s in slices(held[0])])
            return
        starts, hashes = self.of_slice(b"\n".join(held))
        ends = np.cumsum([len(x) + 1 for x in held])
        cuts = np.searchsorted(starts, ends)
        for k, (lo, hi) in enumerate(zip(np.concatenate([[0], cuts[:-1]]), cuts, strict=True)):
            yield first + k, hashes[lo:hi]


def slices(data: bytes) -> Iterator[bytes]:
    """Pieces of about SLICE bytes, cut at white space."""
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of fewer words, the whole sequence as one."""
    if len(words) == 0:
        return words
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = (total ^ mix(words[k : len(words) - width + 1 + k])) * np.uint64(_BASE)
    return np.unique(mix(total))
