"""Quality rules by tokeniser fertility (operator 5).

Method: two public vocabularies (pieces with byte fallback, byte-level BPE)
split every word into tokens (a word's tokens are remembered by the task, by a
64-bit hash, in bounded memory). Per text and vocabulary that gives characters per token, the
share of byte-fallback tokens and the entropy of the token distribution. A text
is rejected if a measure leaves the band of its language, or else of its
script; the least entropy in bits grows with the text's length.

Beside them stand base counts of the text itself: characters in words,
symbols, lines equal to an earlier line, words in repeated three-word windows.

Defined results: a null text is empty: no words, so it fails the base rule;
an empty table gives an empty result; equal rows give equal results; columns
other than id, text and language are ignored; a missing or null language uses
the band of the script. Texts are never cut.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Mapping
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.byte_bpe import vocabulary
from shopcast.llm.common import map_rows, map_texts
from shopcast.llm.shingles import word_spans

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: Words that a task remembers between chunks.
KNOWN_WORDS = 400_000


class Band(NamedTuple):
    """Accepted range of characters per token, most byte-fallback tokens per
    token, least entropy (share of the most possible) under the first
    vocabulary; least characters per token and how far below ``LEAST_BITS`` the
    entropy may lie (None: no matter) under the second."""
    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float
    least_chars_2: float = 0.0
    bits_below: float | None = None


class Measures(NamedTuple):
    """Of a text under both vocabularies; bits: entropy under the second."""
    words: int
    chars: float
    byte_share: float
    entropy: float
    chars_2: float
    bits: float


#: Bands per language, else per script; "other" is for scripts not named. The
#: lower ends of characters lie below 99.9 % of clean labelled texts of 50 words
#: and more.
BANDS: dict[str, Band] = {
    "en": Band(1.93, 8.0, 0.02, 0.42, 1.95, 0.0),
    "de": Band(2.00, 8.0, 0.02, 0.42, 2.05, 0.0),
    "es": Band(1.79, 8.0, 0.02, 0.42, 1.95, 0.0),
    "fr": Band(1.70, 8.0, 0.02, 0.42, 1.75, 0.0),
    "latin": Band(1.65, 8.0, 0.05, 0.40, 1.60, 0.25),
    "cyrillic": Band(1.2, 8.0, 0.05, 0.40),
    "greek": Band(0.8, 8.0, 0.05, 0.40),
    "han": Band(0.3, 4.0, 0.50, 0.40),
    "other": Band(0.2, 8.0, 0.80, 0.30),
}

#: Least entropy in bits of the second vocabulary's tokens, by number of words
#: (from): between clean labelled texts, all languages together, and texts that
#: symbols or bars fill.
LEAST_BITS = ((0, 0.0), (50, 5.25), (70, 5.40), (100, 5.53), (140, 5.65), (200, 5.78), (300, 5.91), (500, 6.0), (1000, 6.08))

#: First code point of each script's main blocks, and the script's name.
SCRIPT_STARTS = ((0x0041, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"),
                 (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "han"), (0xA000, "other"),
                 (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"))


def script(text: str) -> str:
    """Script of most letters: by code point blocks; "other" without letters."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letters = codes[(codes >= 0xC0) | (((codes | 32) >= 97) & ((codes | 32) <= 122))]
    if not len(letters):
        return "other"
    block = np.searchsorted([a for a, _ in SCRIPT_STARTS], letters, "right") - 1
    names = [n for _, n in SCRIPT_STARTS]
    count: dict[str, int] = {}
    for k, n in zip(*np.unique(block, return_counts=True)):
        count[names[k]] = count.get(names[k], 0) + int(n)
    return max(sorted(count), key=count.get)


def base_counts(text: str, words: np.ndarray) -> tuple[int, int, int, int]:
    """(characters in words, symbols, lines equal to an earlier one, words in
    three-word windows that occur twice or more); ``words`` are numbers that
    equal words share."""
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)] if "\n" in text else []
    dup = len(lines) - len(set(lines))
    n = len(words)
    if n < 4:
        return chars, symbols, dup, 0
    if words.max() >> 21:
        words = np.unique(words, return_inverse=True)[1]
        pairs = np.unique(words[:-1] * n + words[1:], return_inverse=True)[1]
        grams = pairs[:-1] * n + words[2:]
    else:
        grams = (words[:-2] << 42) | (words[1:-1] << 21) | words[2:]
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return chars, symbols, dup, 0
    hit = np.zeros(n, bool)
    for at in (order[1:][same], order[:-1][same]):
        hit[at] = hit[at + 1] = hit[at + 2] = True
    return chars, symbols, dup, int(hit.sum())


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class Pieces:
    """Tokens of words under a vocabulary: pieces with byte fallback (.model),
    or byte-level BPE over whole words (.tiktoken), whose byte-fallback tokens
    are single bytes beyond ASCII."""

    def __init__(self, path: str):
        self.bytewise = path.endswith(".tiktoken")
        if self.bytewise:
            import tiktoken
            ranks = read_ranks(path)
            self.model = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
            self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
            self.is_byte[[i for b, i in ranks.items() if len(b) == 1 and b[0] > 127]] = True
        else:
            import sentencepiece
            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.is_byte = np.array([self.model.IsByte(i) for i in range(self.model.GetPieceSize())])
        self.forget()

    def forget(self) -> None:
        self.pieces, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def extend(self, words: list[str]) -> None:
        # The batch call of the byte-level library starts a thread's job per word.
        ids = list(map(self.model.encode_ordinary, words)) if self.bytewise else self.model.encode(words, num_threads=1)
        n = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.pieces = np.concatenate([self.pieces, np.fromiter(chain.from_iterable(ids), np.int32, int(n[-1]))])
        self.start = np.concatenate([self.start, self.start[-1] + n])

    def measures(self, words: np.ndarray, text: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, ...]:
        """(tokens, characters per token, byte share, entropy share, entropy in
        bits) of texts; ``words``: numbers of all words, ``text``: of which
        text, ``chars``: of each text."""
        texts, at, size = len(chars), self.start[words], self.start[words + 1] - self.start[words]
        total = int(size.sum())
        ids = self.pieces[np.repeat(at - np.cumsum(size) + size, size) + np.arange(total)]
        of = np.repeat(text, size)
        n = np.bincount(of, minlength=texts)
        key = np.sort(of * len(self.is_byte) + ids)
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, np.int64)
        count = np.diff(np.append(begin, total))
        one = np.maximum(n, 1)
        logs = np.bincount(key[begin] // len(self.is_byte), count * np.log2(np.maximum(count, 1)), texts)
        entropy = np.where(n > 0, np.log2(one) - logs / one, 0.0)
        most = np.log2(np.minimum(one, len(self.is_byte)))
        share = np.divide(entropy, most, out=np.zeros(texts), where=most > 0)
        return n, chars / one, np.bincount(of, self.is_byte[ids], texts) / one, share, entropy


class Words:
    """Numbers of words by their hashes, and vocabularies that know the same
    words; forgets all words when ``KNOWN_WORDS`` are exceeded."""

    def __init__(self, *paths: str):
        self.pieces = [Pieces(p) for p in paths]
        self.known: dict[int, int] = {}

    def forget(self) -> None:
        self.known.clear()
        for p in self.pieces:
            p.forget()

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number, text) of every word of the texts; new words are learned."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        size = np.array([len(t) + 1 for t in texts], np.int64)
        joined = b"\n".join(texts)
        hashes, start, end = word_spans(joined)
        different, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        found = [self.known.get(h) for h in different.tolist()]
        new = [i for i, k in enumerate(found) if k is None]
        if new:
            at = first[new]
            words = [joined[a:e].decode() for a, e in zip(start[at].tolist(), end[at].tolist())]
            for p in self.pieces:
                p.extend(words)
            for k, i in enumerate(new, len(self.known)):
                found[i] = k
            self.known.update((int(different[i]), found[i]) for i in new)
        which = np.searchsorted(np.cumsum(size) - size, start, "right") - 1
        return np.array(found, np.int64)[back], which


@lru_cache(maxsize=4)
def load(*paths: str) -> Words:
    return Words(*paths)


def least_bits(words: int) -> float:
    return max(bits for n, bits in LEAST_BITS if words >= n)


def in_band(band: Band, m: Measures) -> bool:
    return band.least_chars <= m.chars <= band.most_chars and m.byte_share <= band.most_bytes and m.entropy >= band.least_entropy \
        and m.chars_2 >= band.least_chars_2 and (band.bits_below is None or m.bits >= least_bits(m.words) - band.bits_below)


#: The two vocabularies: pieces with byte fallback, byte-level BPE.
VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")


def tokenizers(paths: tuple[str, str] | None) -> Words:
    return load(*(paths or map(vocabulary, VOCABULARIES)))


def judge(docs: DataFrame, bands: Mapping[str, Band] = BANDS, paths: tuple[str, str] | None = None, min_words: int = MIN_WORDS,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: base counts, measures, verdict ``kept``."""
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), lang.alias("lang")).alias("key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def make():
        words = tokenizers(paths)

        def one(keys, texts):
            out = {n: [] for n in NAMES}
            for key, row in zip(keys, verdicts(words, texts, [k["lang"] for k in keys], bands, min_words)):
                for name, v in zip(NAMES, (key["id"], *row)):
                    out[name].append(v)
            return out
        return one, words.forget
    return map_texts(rows, make, SCHEMA)


def accepted(docs: DataFrame, bands: Mapping[str, Band] = BANDS, paths: tuple[str, str] | None = None, min_words: int = MIN_WORDS,
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns."""
    def make():
        words = tokenizers(paths)

        def one(batch):
            texts = [t or "" for t in batch.column(text_col).cast("string").to_pylist()]
            named = lang_col in batch.schema.names
            langs = batch.column(lang_col).cast("string").to_pylist() if named else [None] * len(texts)
            return batch.filter(pa.array([v[KEPT] for v in verdicts(words, texts, langs, bands, min_words)], pa.bool_()))
        return one, words.forget
    return map_rows(docs, make)


def verdicts(words: Words, texts: list[str], langs: list[str | None], bands: Mapping[str, Band], min_words: int) -> list[tuple]:
    """The columns of ``judge`` beside the id, for each text."""
    numbers, of = words.numbers([t.encode() for t in texts])
    ends = np.cumsum(np.bincount(of, minlength=len(texts)))
    base = [base_counts(t, w) for t, w in zip(texts, np.split(numbers, ends[:-1]))] if texts else []
    chars = np.array([b[0] for b in base], float)
    first, second = ([c.tolist() for c in p.measures(numbers, of, chars)] for p in words.pieces)
    out = []
    for i, (lang, text, (n_chars, symbols, dup, repeat)) in enumerate(zip(langs, texts, base)):
        n = int(ends[i] - (ends[i - 1] if i else 0))
        tokens, per, share, entropy, _ = (c[i] for c in first)
        _, per_2, _, _, bits = (c[i] for c in second)
        failed = n < min_words or 100 * repeat > 50 * n
        band = bands.get(lang) if lang else None
        kind = script(text) if band is None else lang
        band = band or bands.get(kind) or bands["other"]
        kept = not failed and in_band(band, Measures(n, per, share, entropy, per_2, bits))
        out.append((n, n_chars, symbols, dup, repeat, failed, kept, tokens, per, share, entropy, per_2, bits, kind))
    return out


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_tokens long, chars_per_token double, byte_share double, "
          "entropy_share double, chars_per_token_2 double, entropy_bits_2 double, band string")
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
KEPT = NAMES.index("kept") - 1
