"""Plain versions of the operators, one document or all at once, for tests."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b) -> str:
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def shingles(text, size=5):
    w = [x.encode().lower() for x in WORD.findall(text or "")]
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([b" ".join(w)])
    return frozenset(b" ".join(w[i:i + size]) for i in range(len(w) - size + 1))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def near_components(docs):
    """doc_id -> (set size, least reachable doc_id), for unique ids."""
    sets = {d: shingles(t) for d, t in docs}
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def repeats(docs, length):
    """doc_id -> (bytes, removed, spans, digest), for unique ids."""
    first, out = set(), {}
    for d, t in sorted(docs, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in first:
                gone[s:s + length] = b"\1" * length
            first.add(w)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(text):
    """kind -> base spans."""
    out = {}
    for kind, pattern in PII.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            d = "".join(c for c in m.group() if c in "0123456789")
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out[kind].append(m.span())
    return out


def quality(text):
    """(words, characters in words, symbols, repeated lines, words in repeated windows, failed)."""
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    hit = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    n = len(w)
    return (n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


def mix_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """source -> target by repeated sharing; sources in mixing order."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(w[s] for s in free)
        full = {s for s in free if left * w[s] / total >= most * sizes[s]}
        if not full:
            return out | {s: left * w[s] / total for s in free}
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        free -= full
    return out
