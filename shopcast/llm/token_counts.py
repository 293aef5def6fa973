"""Token counts (operator 9) by rank-synchronous array merging.

Method: the pre-tokens of a chunk that are not remembered yet lie in one
ragged numpy array (symbols, sequence starts). In every round each sequence
applies its lowest-rank pair (leftmost first), all sequences at once; the
array is compacted and sequences without a mergeable pair leave with their
number of surviving symbols. A text's count is the sum over its pre-tokens.

The vocabulary file says how a text becomes pre-tokens: NFC, white space
dropped, lower case per character, then the split pattern; the strings of its
special tokens inside a text count as one token each, as the library does by
default.

Defined results: a null text is empty and has 0 tokens; an empty table gives
an empty result; rows are counted one by one, also repeated ones; other
columns are ignored; texts are never cut.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from shopcast.llm.byte_bpe import CACHE_ENTRIES, NO_RANK, PairTable, vocabulary
from shopcast.llm.common import map_texts, text_rows

TOKEN_LIMIT = 2048


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte, as byte-level vocabularies write it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class WordBpe:
    """Counter for a vocabulary file of merges with an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model.get("end_of_word_suffix") or ""
        names = byte_alphabet()
        self.first = np.array([vocab[c] for c in names], np.int64)
        self.last = np.array([vocab[c + end] for c in names], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.pairs = PairTable(left, right, np.arange(len(merges), dtype=np.int64), max(vocab.values()) + 1)
        self.find = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        special = [regex.escape(t["content"]) for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the special strings among them."""
        parts = [text]
        if self.special and "<|" in text:
            parts = self.special.split(text)
        out: list[str] = []
        for p in parts:
            if not p.isascii():
                p = unicodedata.normalize("NFC", p).replace("Σ", "σ")
            out += self.find(p.lower())
        return out, len(parts) - 1

    def merge(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of each non-empty piece."""
        size = np.array([len(p) for p in pieces], np.int64)
        seq = np.repeat(np.arange(len(pieces)), size)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        sym = self.first[flat]
        sym[np.cumsum(size) - 1] = self.last[flat[np.cumsum(size) - 1]]
        out = size.copy()
        rank = np.full(len(sym), NO_RANK, np.int64)
        inner = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inner] = self.pairs.rank(sym[inner], sym[inner + 1])
        while len(sym):
            start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            best = np.minimum.reduceat(rank, start)
            n = np.diff(np.r_[start, len(sym)])
            live = best < NO_RANK
            if not live.all():
                keep = np.repeat(live, n)
                sym, rank, seq = sym[keep], rank[keep], seq[keep]
                best, n = best[live], n[live]
                if not len(sym):
                    break
                start = np.cumsum(n) - n
            hits = np.flatnonzero(rank == np.repeat(best, n))
            at = hits[np.r_[True, seq[hits[1:]] != seq[hits[:-1]]]]
            sym[at] = self.made[best]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            sym, rank, seq = sym[keep], rank[keep], seq[keep]
            out[seq[at]] -= 1
            for p in (at - 1, at):
                p = p[p >= 0]
                ok = p + 1 < len(sym)
                ok[ok] = seq[p[ok]] == seq[p[ok] + 1]
                q = p[ok]
                rank[q] = self.pairs.rank(sym[q], sym[q + 1])
                end = p[~ok]
                rank[end] = NO_RANK
        return out

    def count_batch(self, texts: list[str]) -> list[int]:
        found = [self.pre_tokens(t) for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        new = [t for t in set().union(*(f for f, _ in found)) if t not in self.known] if found else []
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            self.known.update(zip(part, self.merge([t.encode() for t in part]).tolist()))
        get = self.known.__getitem__
        return [sum(map(get, toks)) + n for toks, n in found]


@lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def count_tokens(docs: DataFrame, vocab: str = "word_bpe_49k.json", path: str | None = None,
                 limit: int = TOKEN_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    def make():
        bpe = load(path or vocabulary(vocab))

        def one(keys, texts):
            n = bpe.count_batch(texts)
            return {"doc_id": keys, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n,
                    "over_limit": [x > limit for x in n]}
        return one, bpe.known.clear
    return map_texts(text_rows(docs, id_col, text_col), make,
                     "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
