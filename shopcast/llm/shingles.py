"""Sets of word shingles as sorted arrays of 64-bit hashes, made from a batch
of texts by numpy.

Words are runs of bytes other than space and 09-0D, lower-cased in A-Z. A set
has the distinct shingles of ``size`` words; with fewer words the whole
sequence is the one shingle; without words the set is empty.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
POWERS = np.ones(1, U)
INVERSE = pow(BASE, -1, 1 << 64)
INVERSES = np.ones(1, U)
STEP = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)], U)
GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x ^= x >> U(27)
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global POWERS, INVERSES
    while len(POWERS) < n:
        k = len(POWERS)
        POWERS = np.concatenate([POWERS, POWERS * U(pow(BASE, k, 1 << 64))])
        INVERSES = np.concatenate([INVERSES, INVERSES * U(pow(INVERSE, k, 1 << 64))])
    return POWERS, INVERSES


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word of a lower-cased text, in order."""
    return word_spans(text)[0]


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word of a lower-cased text, in order."""
    b = np.frombuffer(text, np.uint8)
    if not len(b):
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~GAP[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, U)
    at = b.astype(U)
    at += U(1)
    at *= power[:len(b)]
    np.cumsum(at, out=total[1:])
    del at
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(U)), start, end


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    w = word_hashes(text.encode().lower())
    n = len(w)
    if not n:
        return w
    k = size if n >= size else n
    h = np.full(n - k + 1, k, U)
    for i in range(k):
        h += w[i:n - k + 1 + i] * STEP[i % 64] if k == size else mix(w[i:i + 1] + U(i))
    h = mix(h)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def similar(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """Whether 100 * intersection >= percent * union, of non-empty sets."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    n = overlap(a, b)
    return n > 0 and 100 * n >= percent * (len(a) + len(b) - n)
