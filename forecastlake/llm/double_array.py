"""Double-array tries over sequences of 64-bit symbols, walked by many positions at once.

Symbols are numbered in order and written as a fixed number of base-256 digits, so a
node has 256 children at most. The children of node s stand at ``base[s] + digit``
where ``check`` names s. Child sets are placed largest first: all of a size class
propose random bases together, the first to claim a place keeps it, and sets that find
no room get fresh room at the end. Single children fill the free places in order.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np

_ROOT = 256      # places below are never used, so that no base is negative


@dataclass
class DoubleArray:
    symbols: np.ndarray      # sorted uint64
    digits: int
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray       # number of the sequence that ends here, or -1
    sequences: int

    def dump(self) -> bytes:
        return pickle.dumps(self, protocol=5)

    def start(self, count: int) -> np.ndarray:
        return np.full(count, _ROOT, dtype=np.int64)

    def advance(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which states go on, their new states) after one symbol each."""
        at = np.searchsorted(self.symbols, symbol)
        at[at == len(self.symbols)] = 0
        alive = np.flatnonzero(self.symbols[at] == symbol)
        number, state = at[alive], state[alive]
        for k in reversed(range(self.digits)):
            nxt = self.base[state] + ((number >> (8 * k)) & 255)
            good = self.check[nxt] == state
            alive, number, state = alive[good], number[good], nxt[good]
        return alive, state


def build(sequences: list[np.ndarray], seed: int = 0) -> DoubleArray:
    """``sequences``: for each length, a (count, length) array of distinct uint64 rows.

    Sequences are numbered as given. Every symbol array may differ in length; none is empty.
    """
    symbols = np.unique(np.concatenate([s.ravel() for s in sequences]))
    digits = max(1, (max(1, len(symbols) - 1).bit_length() + 7) // 8)
    # Node numbers level by level: a node is (parent, digit).
    parents, labels, ends = [], [], []
    nodes, total = 1, 0
    known: list[tuple[np.ndarray, np.ndarray]] = []      # per depth: sorted keys and their nodes
    for rows in sequences:
        at = np.zeros(len(rows), dtype=np.int64)
        number = np.searchsorted(symbols, rows)
        depth = 0
        for j in range(rows.shape[1]):
            for k in reversed(range(digits)):
                key = (at << 8) | ((number[:, j] >> (8 * k)) & 255)
                if depth == len(known):
                    known.append((np.empty(0, np.int64), np.empty(0, np.int64)))
                keys, ids = known[depth]
                new = np.setdiff1d(key, keys)
                if len(new):
                    parents.append(new >> 8)
                    labels.append(new & 255)
                    keys = np.concatenate([keys, new])
                    ids = np.concatenate([ids, np.arange(nodes, nodes + len(new))])
                    nodes += len(new)
                    order = np.argsort(keys)
                    known[depth] = keys, ids = keys[order], ids[order]
                at = ids[np.searchsorted(keys, key)]
                depth += 1
        ends.append((at, np.arange(total, total + len(rows))))
        total += len(rows)
    base, place, size = _place(np.concatenate(parents), np.concatenate(labels), nodes, seed)
    out = DoubleArray(symbols, digits, np.full(size, 0, np.int32), np.full(size, -1, np.int32),
                      np.full(size, -1, np.int32), total)
    out.base[place] = base
    kids = np.arange(1, nodes)
    out.check[place[kids]] = place[np.concatenate(parents)]
    for at, number in ends:
        out.accept[place[at]] = number
    return out


def _place(parent: np.ndarray, label: np.ndarray, nodes: int, seed: int):
    """(base of each node, place of each node, number of places)."""
    rng = np.random.default_rng(seed)
    order = np.argsort(parent, kind="stable")
    parent, label, child = parent[order], label[order], order + 1
    owner, first, count = np.unique(parent, return_index=True, return_counts=True)
    base = np.zeros(nodes, dtype=np.int64)
    room = _ROOT + 256 + 2 * nodes
    used = np.zeros(room + 256, dtype=bool)
    used[:_ROOT + 1] = True
    fresh = []
    for low in (128, 64, 32, 16, 8, 4, 2):
        todo = np.flatnonzero((count >= low) & (count < 2 * low + (low == 128)))
        for _ in range(24):
            if not len(todo):
                break
            start = rng.integers(_ROOT, room, len(todo))
            k = np.repeat(np.arange(len(todo)), count[todo])
            row = np.repeat(first[todo] - (np.cumsum(count[todo]) - count[todo]), count[todo]) + np.arange(len(k))
            slot = start[k] + label[row]
            bad = used[slot]
            one = np.argsort(slot, kind="stable")       # the first to claim a place keeps it
            bad[one[1:]] |= slot[one[1:]] == slot[one[:-1]]
            lost = np.zeros(len(todo), dtype=bool)
            lost[k[bad]] = True
            used[slot[~lost[k]]] = True
            base[owner[todo[~lost]]] = start[~lost]
            todo = todo[lost]
        fresh.append(todo)
    todo = np.concatenate(fresh)
    base[owner[todo]] = room + 256 + 256 * np.arange(len(todo))
    size = room + 256 * (len(todo) + 2)
    used = np.concatenate([used, np.zeros(size - len(used), dtype=bool)])
    used[room + 256:room + 256 + 256 * len(todo)] = True
    lone = np.flatnonzero(count == 1)
    free = np.flatnonzero(~used[:room])[:len(lone)]
    base[owner[lone]] = free - label[first[lone]]
    place = np.full(nodes, _ROOT, dtype=np.int64)
    place[child] = base[parent] + label
    return base, place, size
