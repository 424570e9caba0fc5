"""Adaptive context-mixing range coder of token ids, many blocks side by side.

Every block is coded from a fresh model, so blocks can be read alone. One step codes one id of
each block (a lane), with numpy over the lanes:

* order 2 and order 1: tables from hashed contexts to the id that followed last, with a
  confidence; order 0: how often each of a block's frequent ids has occurred, and how often
  ids of each size class, which the others are told by;
* mixing: by both confidences, and whether the predictions are equal, an adaptive share of
  the range goes to each order's id, and the rest to order 0;
* a carry-less range coder of 64 bits, which puts out 32 bits at a time.

The calls are most of the cost, so values that do not need 64 bits are kept in 32, and hashes, of
which only low bits count, in 16.
"""

from __future__ import annotations

import numpy as np

U, I, H = np.uint64, np.int32, np.uint16
WORD = U(32)
#: one id takes less than 32 bits of the range; below that, a word is put out
BOT = U(1 << 32)
REST = BOT - U(1)
SLOT_BITS = 10
MIX_BITS, CLASS_BITS, SHARE_BITS = 10, 10, 12
LEAST_MISS = 8  # of 2**MIX_BITS, kept for ids that no context predicts
REBUILD = 32  # steps after which the order-0 shares follow their counts

# classes: ids below 4096 by bit length, others by their upper 4 of 16 bits
_CLASS = np.array([i.bit_length() if i < 4096 else 12 + (i >> 12) for i in range(1 << 16)], np.int64)
CLASSES = 28
#: places for frequent ids of a block, which order 0 predicts one by one
FREQUENT_BITS = 5
FREQUENT = 1 << FREQUENT_BITS
SYMBOLS = CLASSES + FREQUENT
WIDTH = -(-SYMBOLS // 8)
_FIRST = np.array([0, *[1 << b for b in range(12)], *[k << 12 for k in range(1, 16)]])  # smallest id of a class
_BITS = np.array([0, *range(12), *[12] * 15], np.uint64)  # bits that tell its ids apart
# the same of all symbols: a frequent id has no bits of its own; and the bits that tell ids apart, set
_SYMBOL_FIRST = np.append(_FIRST, np.zeros(FREQUENT, _FIRST.dtype)).astype(np.int32)
_SYMBOL_BITS = np.append(_BITS, np.zeros(FREQUENT, U))
_SYMBOL_REST = (U(1) << _SYMBOL_BITS) - U(1)


class _Model:
    """Predictions for ``lanes`` blocks; lanes beyond the first ``m`` have ended."""

    def __init__(self, lanes: int, searched: bool) -> None:
        self.searched = searched  # symbols will be looked for by their place in the range
        self.one = np.full(lanes << SLOT_BITS, -4, np.int32)  # id and confidence 0 to 3 in the low bits
        self.two = np.full(lanes << SLOT_BITS, -4, np.int32)
        self.hot = np.full(lanes << FREQUENT_BITS, -4, np.int32)  # likewise
        # the share of order 2 above 16 bits, that of order 1 in them
        first = [(64 + 900 * (s >> 3)) << 16 | 64 + 900 * (s >> 1 & 3) for s in range(32)]
        self.shares = np.tile(np.array(first, np.int32), lanes)
        # whole numbers, as floats: their shares are quotients
        begun = np.ones(SYMBOLS)
        begun[:CLASSES] = 1 << np.maximum(0, _BITS.astype(np.int64) - 8)
        self.counts = np.tile(begun, (lanes, 1))
        self.quotients, self.sizes = np.empty((lanes, SYMBOLS)), np.empty((lanes, SYMBOLS), np.int64)
        self.cum = np.zeros((lanes, SYMBOLS + 1), np.int64)
        self.cum_row = np.arange(lanes, dtype=np.int64) * (SYMBOLS + 1)
        self.table = np.arange(lanes, dtype=np.int64) << SLOT_BITS
        self.state = np.arange(lanes, dtype=np.int64) << 5
        self.count_row = np.arange(lanes, dtype=np.int64) * SYMBOLS
        self.seen: list[np.ndarray] = []  # places in the counts since they were last added up
        self.hash2 = np.zeros(lanes, H)  # of the last two ids
        self.hash1 = np.zeros(lanes, H)  # of the last one
        self.steps = 0

    def rebuild(self, m: int) -> None:
        if self.seen:
            found = np.bincount(np.concatenate(self.seen), minlength=self.counts.size)
            found <<= 2
            self.counts += found.reshape(self.counts.shape)
            self.seen.clear()
        # whole numbers this small have a quotient whose whole part is exact
        c, q, f = self.counts[:m], self.quotients[:m], self.sizes[:m]
        np.multiply(c, float((1 << CLASS_BITS) - SYMBOLS), out=q)
        q /= c.sum(1, keepdims=True)
        np.copyto(f, q, casting="unsafe")
        f += 1
        np.cumsum(f, 1, out=self.cum[:m, 1:])
        self.cum[:m, SYMBOLS] = 1 << CLASS_BITS
        if self.searched:
            # ends of the symbols by eights, and of every eighth, for a search in two steps
            self.ends = np.full((m, WIDTH * 8), 1 << CLASS_BITS, np.int16)
            self.ends[:, :SYMBOLS] = self.cum[:m, 1:]
            self.eighths = np.ascontiguousarray(self.ends[:, 7::8])
            self.ends = self.ends.reshape(-1, 8)

    def predict(self, m: int, rng: np.ndarray) -> None:
        """Sets both predictions and where their shares end in a range of that many 2**MIX_BITS."""
        if self.steps % REBUILD == 0:
            self.rebuild(m)
        self.steps += 1
        self.slot1 = self.table[:m] + (self.hash1[:m] >> 4 & H((1 << SLOT_BITS) - 1))
        self.slot2 = self.table[:m] + (self.hash2[:m] >> 5 & H((1 << SLOT_BITS) - 1))
        # all places are in the tables; to clip them is less than to check them
        self.e1, self.e2 = self.one.take(self.slot1, mode="clip"), self.two.take(self.slot2, mode="clip")
        self.p1, self.p2 = self.e1 >> 2, self.e2 >> 2
        self.c1, self.c2 = self.e1 & 3, self.e2 & 3
        self.at = self.state[:m] + (self.c2 << 3 | self.c1 << 1 | (self.p1 == self.p2))
        share = self.shares.take(self.at, mode="clip")
        self.s2, self.s1 = share >> 16, share & 0xFFFF
        end2 = self.s2 >> (SHARE_BITS - MIX_BITS)
        left = (1 << MIX_BITS) - LEAST_MISS - 1 - end2
        end1 = end2 + 1 + (left * self.s1 >> SHARE_BITS)
        self.end2, self.end1 = rng * end2.astype(U), rng * end1.astype(U)

    def narrowed(self, low: np.ndarray, rng: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of what was right: order 2, order 1, or neither."""
        start = np.where(hit1, self.end2, self.end1)
        end = np.where(hit1, self.end1, rng << U(MIX_BITS))
        return np.where(hit2, low, low + start), np.where(hit2, self.end2, end - start)

    def hot_places(self, missed: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Where the ids of the missed lanes would be among the frequent ones."""
        return (missed << FREQUENT_BITS) + (y.astype(H) * H(40_503) >> 6 & H(FREQUENT - 1))

    def update(
        self,
        x: np.ndarray,
        hit2: np.ndarray,
        hit1: np.ndarray,
        missed: np.ndarray,
        y: np.ndarray,
        place: np.ndarray,
        held: np.ndarray,
        symbols: np.ndarray,
    ) -> None:
        """``hit1``: only order 1 was right. Of the missed lanes: ids, place among the frequent ones, what is held there, symbols."""
        s2 = self.s2 + ((hit2 * I(3936) + I(32) - self.s2) >> 5)
        s1 = self.s1 + ((hit1 * I(3936) + I(32) - self.s1) * ~hit2 >> 5)
        self.shares[self.at] = s2 << 16 | s1
        new = x << 2 | 1
        self.two[self.slot2] = np.where(hit2, self.e2 + (self.c2 < 3), np.where(self.c2 > 0, self.e2 - 1, new))
        right1 = self.p1 == x
        self.one[self.slot1] = np.where(right1, self.e1 + (self.c1 < 3), np.where(self.c1 > 0, self.e1 - 1, new))
        self.seen.append(self.count_row.take(missed) + symbols)
        # an id that comes again stays; one that is in the way for long gives way
        confidence = held & 3
        known = symbols >= CLASSES
        self.hot[place] = np.where(known, held + (confidence < 3), np.where(confidence > 0, held - 1, y << 2 | 1))
        h = x.astype(H)
        h1 = h * H(40_503)
        self.hash2[: len(x)] = h * H(2_654_435 & 0xFFFF) + self.hash1[: len(x)]
        self.hash1[: len(x)] = h1


def _ends_below(ends: np.ndarray, share: np.ndarray) -> np.ndarray:
    """How many of eight ends each share has reached; the eight answers are bytes of one word."""
    return np.bitwise_count((ends <= share[:, None]).view(U)[:, 0]).astype(np.int64)


def _by_length(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Lanes from the longest to the shortest, and how many have more than t ids, for each t."""
    n = np.array(lengths)
    order = np.argsort(-n, kind="stable")
    return order, np.searchsorted(-n[order], -np.arange(int(n.max(initial=0))), side="left")


def _cut(low: np.ndarray, rng: np.ndarray) -> np.ndarray:
    """The range after its highest word has been put out, less what lies beyond that word."""
    settled = (low ^ (low + rng)) <= REST
    return np.where(settled, rng, (~low + U(1)) & REST) << WORD


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block of ids below 65536."""
    if not blocks:
        return []
    order, active = _by_length([len(b) for b in blocks])
    ids = np.zeros((len(active), len(blocks)), np.uint16)
    for lane, b in enumerate(order):
        ids[: len(blocks[b]), lane] = blocks[b]
    lanes = len(blocks)
    model, low, rng = _Model(lanes, False), np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
    out, end = np.zeros((lanes, 256), np.uint32), np.zeros(lanes, np.int64)
    for t, m in enumerate(active):
        x = ids[t, :m].astype(I)
        r = rng[:m] >> U(MIX_BITS)
        model.predict(m, r)
        hit2 = model.p2 == x
        hit1 = (model.p1 == x) & ~hit2
        l, r = model.narrowed(low[:m], r, hit2, hit1)
        missed = np.flatnonzero(~(hit2 | hit1))
        y = x.take(missed)
        c = _CLASS.take(y)
        place = model.hot_places(missed, y)
        held = model.hot.take(place, mode="clip")
        known = held >> 2 == y
        symbol = np.where(known, CLASSES + (place & FREQUENT - 1), c)
        cell = model.cum_row.take(missed) + symbol
        cum = model.cum.reshape(-1)
        lo = cum.take(cell, mode="clip")
        rm = r.take(missed) >> U(CLASS_BITS)
        lm = l.take(missed) + rm * lo.view(U)
        rm = (rm * (cum.take(cell + 1, mode="clip") - lo).view(U)) >> _SYMBOL_BITS.take(symbol)
        l[missed] = lm + rm * (y.astype(U) & _SYMBOL_REST.take(symbol))
        r[missed] = rm
        short = np.flatnonzero(r < BOT)
        if len(short):
            ls = l.take(short)
            r[short] = _cut(ls, r.take(short))
            e = end[short]
            if e.max() >= out.shape[1]:
                out = np.concatenate([out, np.zeros_like(out)], 1)
            out.reshape(-1)[short * out.shape[1] + e] = ls >> WORD
            end[short] = e + 1
            l[short] = ls << WORD
        low[:m], rng[:m] = l, r
        model.update(x, hit2, hit1, missed, y, place, held, symbol)
    tail = np.stack([low >> WORD, low & REST], 1).astype(np.uint32)
    found = [b""] * lanes
    for lane, b in enumerate(order):
        found[b] = np.concatenate([out[lane, : end[lane]], tail[lane]]).astype("<u4").tobytes()
    return found


def decode(codes: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The blocks of these codes and lengths, as unsigned 16-bit integers."""
    if not codes:
        return []
    order, active = _by_length(lengths)
    lanes = len(codes)
    words = [np.frombuffer(codes[b], "<u4") for b in order]
    held = np.zeros((lanes, max(map(len, words)) + 8), np.uint32)
    for lane, w in enumerate(words):
        held[lane, : len(w)] = w
    ids = np.zeros((len(active), lanes), np.uint16)
    model, low, rng = _Model(lanes, True), np.zeros(lanes, U), np.full(lanes, 2**64 - 1, U)
    code, place = held[:, 0].astype(U) << WORD | held[:, 1], np.full(lanes, 2)
    width, words_held = held.shape[1], held.reshape(-1)
    for t, m in enumerate(active):
        l, r, v = low[:m], rng[:m] >> U(MIX_BITS), code[:m]
        model.predict(m, r)
        above = v - l
        hit2 = above < model.end2
        hit1 = ~hit2 & (above < model.end1)
        l, r = model.narrowed(l, r, hit2, hit1)
        x = np.where(hit2, model.p2, model.p1)
        missed = np.flatnonzero(~(hit2 | hit1))
        rm, lm, vm = r.take(missed) >> U(CLASS_BITS), l.take(missed), v.take(missed)
        share = np.minimum((vm - lm) // rm, U((1 << CLASS_BITS) - 1)).astype(np.int16)
        eighth = _ends_below(model.eighths.take(missed, 0), share)
        symbol = 8 * eighth + _ends_below(model.ends.take(missed * WIDTH + eighth, 0), share)
        cell = model.cum_row.take(missed) + symbol
        cum = model.cum.reshape(-1)
        lo = cum.take(cell, mode="clip")
        lm = lm + rm * lo.view(U)
        rm = (rm * (cum.take(cell + 1, mode="clip") - lo).view(U)) >> _SYMBOL_BITS.take(symbol)
        off = np.minimum((vm - lm) // rm, _SYMBOL_REST.take(symbol))
        frequent = model.hot.take((missed << FREQUENT_BITS) + (symbol - CLASSES & FREQUENT - 1), mode="clip") >> 2
        y = np.where(symbol >= CLASSES, frequent, _SYMBOL_FIRST.take(symbol) + off.astype(I))
        x[missed] = y
        l[missed], r[missed] = lm + rm * off, rm
        short = np.flatnonzero(r < BOT)
        if len(short):
            ls = l.take(short)
            r[short] = _cut(ls, r.take(short))
            p = place[short]
            code[short] = code.take(short) << WORD | words_held.take(short * width + np.minimum(p, width - 1))
            place[short] = p + 1
            l[short] = ls << WORD
        low[:m], rng[:m] = l, r
        ids[t, :m] = x
        hot = model.hot_places(missed, y)
        model.update(x, hit2, hit1, missed, y, hot, model.hot.take(hot, mode="clip"), symbol)
    found: list[np.ndarray] = [np.zeros(0, np.uint16)] * lanes
    for lane, b in enumerate(order):
        found[b] = ids[: lengths[b], lane].copy()
    return found
