"""Bounded caches of pieces of text, and what a Python worker keeps from one task to the next."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterable, Iterator
from itertools import islice
from types import ModuleType
from typing import Any

GENERATION = 200_000
LONG = 64  # signs; longer pieces are not kept
AT_ONCE = 200_000  # pieces of a text that are looked up together
_KEPT = "_termloom_kept"


class PieceCache(dict):
    """Bytes of pieces; ``make`` gives those of a new piece.

    Pieces live in two generations. When the young one, which is this dictionary, is full, it
    becomes the old one, and an old piece that is asked for again becomes young, so frequent
    pieces stay.
    """

    def __init__(self, make: Callable[[Any], bytes], generation: int = GENERATION) -> None:
        super().__init__()
        self.make, self.generation = make, generation
        self.old: dict[Any, bytes] = {}

    def __missing__(self, piece: Any) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
        if len(piece) <= LONG:
            if len(self) >= self.generation:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found

    def joined(self, pieces: Iterable[Any]) -> bytes:
        """The bytes of the pieces one after the other."""
        return b"".join(map(self.__getitem__, pieces))

    def joined_in_parts(self, pieces: Iterator[Any]) -> bytes:
        """The same for a text of very many pieces, without a list of them all."""
        out = []
        while part := list(islice(pieces, AT_ONCE)):
            out.append(self.joined(part))
        return b"".join(out)


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave when this process first asked for ``key``.

    A worker process runs many tasks one after the other, each of which unpickles this code
    anew; so what is kept hangs on a module of its own. Only for what has a bounded size.
    """
    store = sys.modules.setdefault(_KEPT, ModuleType(_KEPT)).__dict__.setdefault("held", {})
    if key not in store:
        store[key] = make()
    return store[key]
