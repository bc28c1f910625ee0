"""Bidirectional FM-index of a delimited vocabulary, with a search scheme for one error.

The text is ``$w1$w2$...$wn$`` read as a circle, the words sorted; its rotations are
sorted by doubling. As ``$`` is the smallest symbol, the rotation that begins with
``$wi$`` has rank i, so the rank interval of a whole delimited word names the word.
A pattern's intervals among the rotations of the text and of the reversed text are
kept side by side, so it can grow at either end. Ranks come from bit vectors, one for
each symbol s, that mark the places where the last column is below s.

All searches of a batch advance together in numpy.
"""

from __future__ import annotations

import numpy as np


def rotation_order(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``text`` in order; they must all differ."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    span = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for k in range(span):
        key = (key << bits) | np.roll(text, -k).astype(np.int64)
    while True:
        order = np.argsort(key, kind="stable")
        step = np.empty(n, dtype=bool)
        step[0] = False
        step[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1:
            return order
        if span >= n:
            raise ValueError("equal rotations have no order")
        key = rank * n + np.roll(rank, -span)
        span *= 2


class Ranks:
    """For each symbol s and place i: how many of the first i entries are below s."""

    def __init__(self, last: np.ndarray, symbols: int):
        n = len(last)
        self.last = last
        self.words = n // 64 + 1
        bits = np.zeros((symbols + 1, self.words * 64), dtype=np.uint8)
        for s in range(symbols + 1):
            bits[s, :n] = last < s
        self.bits = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.bits).astype(np.int32)
        self.before = np.cumsum(ones, axis=1, dtype=np.int32) - ones
        self.bits, self.before = self.bits.ravel(), self.before.ravel()

    def below(self, s: np.ndarray, i: np.ndarray) -> np.ndarray:
        at = s * self.words + (i >> 6)
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.bits[at] & mask)


class Index:
    """``words``: distinct, not empty, sorted Latin-1 byte strings."""

    def __init__(self, words: list[bytes]):
        raw = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", dtype=np.uint8)
        alphabet = np.unique(raw)
        #: Symbol of each byte; -1 where no word has it.
        self.symbol = np.full(256, -1, dtype=np.int64)
        self.symbol[alphabet] = np.arange(len(alphabet))
        self.symbols = len(alphabet)
        text = self.symbol[raw]
        self.size = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])
        self.sides = []
        for t in (text, text[::-1]):
            order = rotation_order(t)
            self.sides.append(Ranks(t[order - 1], self.symbols))

    def extend(self, side: int, s, lo, other, size):
        """Prepend (side 0) or append (side 1) symbols; ``lo`` belongs to the side's own order."""
        r = self.sides[side]
        low0, low1 = r.below(s, lo), r.below(s, lo + size)
        up0, up1 = r.below(s + 1, lo), r.below(s + 1, lo + size)
        return self.first[s] + up0 - low0, other + low1 - low0, (up1 - low1) - (up0 - low0)

    def children(self, side: int, lo, size):
        """(state, symbol) of every symbol but ``$`` that can extend a state."""
        r = self.sides[side]
        few = size <= 8
        a = np.flatnonzero(few & (size > 0))
        count = size[a]
        state = np.repeat(a, count)
        at = np.repeat(lo[a] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        key = np.unique(state * self.symbols + r.last[at])
        b = np.flatnonzero(~few)
        if len(b):
            edge = np.arange(self.symbols + 1)[None, :]
            held = r.below(edge, (lo + size)[b][:, None]) - r.below(edge, lo[b][:, None])
            row, sym = np.nonzero(np.diff(held, axis=1))
            key = np.concatenate([key, b[row] * self.symbols + sym])
        state, sym = np.divmod(key, self.symbols)
        keep = sym > 0
        return state[keep], sym[keep]

    def one_error(self, words: list[bytes], halves: np.ndarray, mirrored: bool = False):
        """(query, word) pairs: indexed words that differ from a query by one error behind its half.

        ``halves``: how many code points match exactly, at the query's start, or at its end
        if ``mirrored``. The half is matched towards the word's end (its start and ``$``),
        then the other half is extended, allowing one inserted, deleted or replaced code
        point. Pairs may repeat. In a mirrored search every word and the roles of both
        orders are reversed.
        """
        back, on = (1, 0) if mirrored else (0, 1)
        m = len(words)
        length = np.array([len(w) for w in words], dtype=np.int64)
        off = np.cumsum(length) - length
        text = self.symbol[np.frombuffer(b"".join(w[::-1] for w in words) if mirrored else b"".join(words),
                                         dtype=np.uint8)]
        q = np.arange(m)
        lo, other, size = np.zeros(m, np.int64), np.zeros(m, np.int64), np.full(m, self.size)
        at = halves - 1
        while True:      # the exact half, from its inner end to the delimiter
            alive = (size > 0) & (at >= -1)
            q, lo, other, size, at = (x[alive] for x in (q, lo, other, size, at))
            todo = np.flatnonzero(at >= -1)
            if not len(todo) or bool((at == -2).all()):
                break
            s = np.where(at >= 0, text[off[q] + np.maximum(at, 0)], 0)
            known = s >= 0
            q, lo, other, size, at, s = (x[known] for x in (q, lo, other, size, at, s))
            lo, other, size = self.extend(back, s, lo, other, size)
            at = at - 1
            done = at == -2
            if done.any():
                yield from self._rest(on, text, off, length, halves, q[done], other[done], lo[done], size[done])
                q, lo, other, size, at = (x[~done] for x in (q, lo, other, size, at))

    def _rest(self, on, text, off, length, halves, q, lo, other, size):
        """Extend across the other half; yields (query, word) arrays."""
        keep = size > 0
        q, lo, other, size = (x[keep] for x in (q, lo, other, size))
        at = halves[q]
        pool = [np.empty(0, np.int64)] * 5
        while len(q) or len(pool[0]):
            born = []
            if len(q):
                inside = at < length[q]
                want = np.where(inside, text[np.minimum(off[q] + at, len(text) - 1)], -2)
                state, sym = self.children(on, lo, size)
                other_sym = sym != want[state]
                state, sym = state[other_sym], sym[other_sym]
                clo, cother, csize = self.extend(on, sym, lo[state], other[state], size[state])
                born.append((q[state], at[state], clo, cother, csize))                      # one more in the word
                sub = inside[state]
                born.append((q[state][sub], at[state][sub] + 1, clo[sub], cother[sub], csize[sub]))   # another one
                # A run's code points are alike: only its first one is taken out.
                fresh = inside & ((at == halves[q]) | (want != text[np.maximum(off[q] + at - 1, 0)]))
                born.append((q[fresh], at[fresh] + 1, lo[fresh], other[fresh], size[fresh]))
                go = inside & (want >= 0)
                q, at, lo, other, size, want = (x[go] for x in (q, at, lo, other, size, want))
                lo, other, size = self.extend(on, want, lo, other, size)
                at = at + 1
                keep = size > 0
                q, at, lo, other, size = (x[keep] for x in (q, at, lo, other, size))
            # States with their error spent go on exactly, and end with the delimiter.
            eq, eat, elo, eother, esize = pool
            if len(eq):
                inside = eat < length[eq]
                s = np.where(inside, text[np.minimum(off[eq] + eat, len(text) - 1)], 0)
                known = s >= 0
                eq, eat, elo, eother, esize, s, inside = (
                    x[known] for x in (eq, eat, elo, eother, esize, s, inside))
                elo, eother, esize = self.extend(on, s, elo, eother, esize)
                hit = ~inside & (esize > 0)
                if hit.any():
                    # Rank among the rotations of the text itself: 0 is the circle's seam.
                    yield eq[hit], (elo if on == 0 else eother)[hit] - 1
                keep = inside & (esize > 0)
                eq, eat, elo, eother, esize = (x[keep] for x in (eq, eat + 1, elo, eother, esize))
            pool = [np.concatenate(x) for x in zip((eq, eat, elo, eother, esize), *born)]
