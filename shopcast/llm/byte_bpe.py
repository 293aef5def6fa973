"""Byte-level BPE encoding and decoding (operator 6).

Method: the distinct pre-tokens of a chunk are put into length buckets, each a
padded numpy matrix of token ids (one row per pre-token). In each round every
row merges its leftmost pair of minimum rank; the rank of a pair comes from an
open-addressing hash table held in numpy arrays, and the matrix is compacted
(the merged column closes, finished rows leave). A pre-token's ids are
remembered by the task (bounded memory), so each distinct pre-token is merged
about once per task.

Defined results: a null text is the empty text (no ids, empty bytes); equal
rows give equal results; an empty table gives an empty result; other columns
of the input, whatever their names, are ignored; texts are never cut. A
pre-token of more than ``LONG`` bytes is merged by an exact heap instead of a
matrix row (a row costs the square of its length).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from shopcast.llm.common import map_texts, text_rows

LONG = 1024
#: Pre-tokens that a task remembers between chunks.
CACHE_ENTRIES = 300_000
NO_RANK = np.int64(1 << 40)


class PairTable:
    """Hash table (left id, right id) -> rank of the merged token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, n_ids: int):
        self.n_ids = np.uint64(n_ids)
        bits = max(4, int(np.ceil(np.log2(max(1, len(rank)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
        self.vals = np.full(1 << bits, NO_RANK, np.int64)
        key = left.astype(np.uint64) * self.n_ids + right.astype(np.uint64)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            at = slot[todo]
            free = self.keys[at] == np.iinfo(np.uint64).max
            first = np.zeros(len(todo), bool)
            first[np.unique(np.where(free, at, -1), return_index=True)[1]] = True
            put = todo[free & first]
            self.keys[slot[put]], self.vals[slot[put]] = key[put], rank[put]
            todo = todo[~(free & first)]
            slot[todo] = np.where(self.keys[slot[todo]] == key[todo], slot[todo], (slot[todo] + 1) & self.mask)
            todo = todo[self.keys[slot[todo]] != key[todo]]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_RANK`` where the pair does not merge."""
        key = left.astype(np.uint64) * self.n_ids + right.astype(np.uint64)
        slot = self._slot(key)
        out = np.full(len(key), NO_RANK, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.vals[slot[todo[hit]]]
            todo = todo[~hit & (found != np.iinfo(np.uint64).max)]
            slot[todo] = (slot[todo] + 1) & self.mask
        return out


class ByteBpe:
    """Encoder and decoder for a rank file (base64 token, space, rank)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.find = regex.compile(pattern).findall
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int64),
                               max(self.ranks.values()) + 1)
        self.known: dict[str, bytes] = {}

    def merge_bucket(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length: one padded matrix row each."""
        size = np.array([len(p) for p in pieces])
        width = int(size.max())
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < size[:, None], self.byte_id[flat], -1)
        rank = np.full((len(pieces), width), NO_RANK, np.int64)
        live = ids[:, 1:] >= 0
        rank[:, :-1][live] = self.pairs.rank(ids[:, :-1][live], ids[:, 1:][live])
        row, out = np.arange(len(pieces)), [None] * len(pieces)
        while len(row):
            at = rank.argmin(axis=1)
            r = np.arange(len(row))
            best = rank[r, at]
            done = best == NO_RANK
            if done.any():
                for i in np.flatnonzero(done):
                    out[row[i]] = ids[i, :size[row[i]]].copy()
                keep = ~done
                row = row[keep]
                if not len(row):
                    break
                width = int(size[row].max())
                ids, rank, at, best = ids[keep, :width], rank[keep, :width], at[keep], best[keep]
                r = np.arange(len(row))
            ids[r, at] = best
            src = np.arange(width)[None, :]
            src = np.minimum(src + (src > at[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, src, 1), np.take_along_axis(rank, src, 1)
            size[row] -= 1
            tail = np.flatnonzero(size[row] < width)
            ids[tail, size[row][tail]] = -1
            rank[r, size[row] - 1] = NO_RANK
            for shift in (-1, 0):
                p = at + shift
                ok = np.flatnonzero((p >= 0) & (p + 1 < size[row]))
                rank[ok, p[ok]] = self.pairs.rank(ids[ok, p[ok]], ids[ok, p[ok] + 1])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Exact merge of one long piece: linked list and heap."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        rank = self.pairs.rank(ids[:-1], ids[1:])
        ids = ids.tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 1, ids[i], ids[i + 1]) for i, r in enumerate(rank.tolist()) if r < NO_RANK]
        heapq.heapify(heap)
        ranks, token = self.ranks, self.bytes_of
        while heap:
            r, i, j, a, b = heapq.heappop(heap)
            if ids[i] != a or nxt[i] != j or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < n:
                    m = ranks.get(token[ids[x]] + token[ids[y]])
                    if m is not None:
                        heapq.heappush(heap, (m, x, y, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int64)

    def learn(self, tokens: set[str]) -> None:
        """Merge the pre-tokens that are not remembered yet."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        new = [(t, t.encode()) for t in tokens if t not in self.known]
        buckets: dict[int, list] = {}
        for t, piece in new:
            whole = self.ranks.get(piece)
            if whole is not None:
                self.known[t] = np.array([whole], "<u4").tobytes()
            elif len(piece) > LONG:
                self.known[t] = self.merge_long(piece).astype("<u4").tobytes()
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append((t, piece))
        for k, items in buckets.items():
            step = max(1, (1 << 20) >> k)
            for i in range(0, len(items), step):
                part = items[i:i + step]
                for (t, _), ids in zip(part, self.merge_bucket([p for _, p in part])):
                    self.known[t] = ids.astype("<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        found = [self.find(t) for t in texts]
        self.learn(set().union(*found) if found else set())
        get = self.known.__getitem__
        return [b"".join(map(get, toks)) for toks in found]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def encode(docs: DataFrame, vocab: str = "byte_bpe_multi_50k.tiktoken", path: str | None = None,
           split: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids binary: little-endian u32, decoded binary) of
    every row. ``path`` names a rank file that all executors can open;
    otherwise the installed public vocabulary ``vocab`` is used."""
    def make():
        bpe = load(path or vocabulary(vocab), split or pattern())

        def one(keys, texts):
            ids = bpe.encode_batch(texts)
            return {"doc_id": keys, "n_tokens": [len(x) // 4 for x in ids], "ids": ids,
                    "decoded": [bpe.decode(x) for x in ids]}
        return one, bpe.known.clear
    return map_texts(text_rows(docs, id_col, text_col), make,
                     "doc_id long, n_tokens long, ids binary, decoded binary")


def encode_digest(docs: DataFrame, vocab: str = "byte_bpe_multi_50k.tiktoken", path: str | None = None,
                  split: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with SHA-256 digests of ids and decoded bytes made in
    the task instead of the bytes themselves."""
    def make():
        bpe = load(path or vocabulary(vocab), split or pattern())
        sha = hashlib.sha256

        def one(keys, texts):
            ids = bpe.encode_batch(texts)
            return {"doc_id": keys, "n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [sha(x).hexdigest() for x in ids],
                    "decoded_sha256": [sha(bpe.decode(x)).hexdigest() for x in ids]}
        return one, bpe.known.clear
    return map_texts(text_rows(docs, id_col, text_col), make,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
