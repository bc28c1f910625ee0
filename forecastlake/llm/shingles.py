"""Word shingles of whole texts as 64-bit hashes, vectorised over an Arrow batch.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z only.
A document's set holds the distinct n-word shingles; with fewer words the whole
sequence is one shingle; a null text or one without words has an empty set.
Shingles are compared by a 64-bit hash of their words' bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_P = U(0x9E3779B97F4A7C15)          # odd, so it has an inverse modulo 2**64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), dtype=np.uint64)
    out[0] = 1
    done, step = 1, base % 2**64
    while done < n:
        m = min(done, n - done)
        out[done:done + m] = out[:m] * U(step)
        done += m
        step = step * step % 2**64
    return out


_INV = pow(int(_P), -1, 2**64)
_POW = _powers(int(_P), 1 << 16)
_IPOW = _powers(_INV, 1 << 16)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _IPOW
    if n > len(_POW):
        _POW, _IPOW = _powers(int(_P), 2 * n), _powers(_INV, 2 * n)
    return _POW, _IPOW


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start offset, hash) of every word in a run of UTF-8 bytes."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    low = _LOWER[data]
    word = ~_SPACE[low]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    pw, inv = _power_tables(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + U(1)) * pw[:len(data)], out=total[1:])
    h = (total[end] - total[start]) * inv[start]
    return start, mix(h + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def sets_of(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text (empty for null or blank)."""
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("")
    if not len(texts):
        return []
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    out = []
    # Some megabytes at a time: the hash arrays take eight bytes for each byte of text.
    i = 0
    while i < len(texts):
        j = i + 1
        while j < len(texts) and off[j + 1] - off[i] <= 1 << 20:
            j += 1
        out.extend(_sets(data, off[i:j + 1], n))
        i = j
    return out


def _sets(data: np.ndarray, off: np.ndarray, n: int) -> list[np.ndarray]:
    starts, hashes, counts = [], [], []
    # One space between texts keeps a word from running into the next text.
    size = np.diff(off)
    joined = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
    at = 0
    begin = np.empty(len(size) + 1, dtype=np.int64)
    for k, s in enumerate(size):
        begin[k] = at
        joined[at:at + s] = data[off[k]:off[k + 1]]
        at += int(s) + 1
    begin[-1] = at
    starts, hashes = word_hashes(joined)
    counts = np.searchsorted(starts, begin)
    if len(hashes) >= n:
        sh = hashes[:len(hashes) - n + 1].copy()
        for k in range(1, n):
            sh = mix(sh * U(0x9FB21C651E98DF25) + hashes[k:len(hashes) - n + 1 + k])
    else:
        sh = np.empty(0, np.uint64)
    out = []
    for k in range(len(size)):
        a, b = int(counts[k]), int(counts[k + 1])
        if b - a >= n:
            out.append(np.unique(sh[a:b - n + 1]))
        elif b > a:
            x = hashes[a:a + 1]
            for w in range(a + 1, b):
                x = mix(x * U(0x9FB21C651E98DF25) + hashes[w:w + 1])
            # Fewer words than n: set apart from the n-word shingles by length.
            out.append(mix(x + U(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
