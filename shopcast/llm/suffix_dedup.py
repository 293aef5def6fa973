"""Suffix-array dedup (operator 1): remove bytes covered by a string of
``length`` bytes that also starts earlier.

Method, over whole texts as UTF-8 bytes:

1. Every window of ``length`` bytes is owned by its anchor, the least-hashed
   gram inside it (about one anchor per 35 bytes), so equal windows have equal
   anchors. Neighbouring windows of one anchor form a context of up to 168
   bytes. Only (gram, context hash, place) leaves the task; a context that
   occurs again in the same batch is covered at once (map-side combine).
2. Sorted by gram, a stream finds contexts equal to an earlier one (covered)
   and grams with several different contexts; nothing else can hold a repeat.
3. Of those grams the bytes of each different context are fetched, and blocks
   of them get a suffix array by two-stage sorting: suffixes smaller than
   their successors are sorted directly, the others are induced by scanning
   the buckets in order. Adjacent common prefixes of ``length`` bytes or more
   join equal windows; all but the first are covered. A gram whose contexts
   fill several blocks hands on one row per different window of a block, and
   a grouped minimum over those settles what blocks share.
4. Covered intervals meet their document, which is cut in one pass.

Defined results: a null text is empty; texts shorter than ``length`` lose
nothing; "earlier" is a smaller (doc_id, start), null ids before all others;
of rows with one doc_id (or none), as many as there are, different texts count
as documents in the order of a 64-bit hash of their texts and equal rows as the
same document (both keep what only they share); an empty table gives an empty result; other columns are ignored by
``find_repeats`` and kept by ``remove_repeats``, which drops the bytes of cut
characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import free_names, shared

LENGTH = 100
#: Bytes of contexts in one suffix array, bytes of text in one step of a scan.
BLOCK_BYTES, SCAN_BYTES = 1 << 20, 1 << 24
STARTS = 1 << 20
NULL_ID = -(1 << 63)
U = np.uint64


def contexts(b: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, start, end) of the contexts of a text; each covers the windows
    that start in [start, end - length]."""
    parts = []
    for at in range(0, len(b) - length + 1, STARTS):
        parts.append(_contexts(b[at:at + STARTS + length - 1], length, at))
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*parts))


def _contexts(b: bytes, length: int, base: int):
    k = 32 if length >= 64 else 8
    m = len(b) - k + 1
    word = np.ndarray((len(b) - 7,), "<u8", b, strides=(1,))
    h = word[:m] * U(0x9E3779B97F4A7C15)
    for i, c in zip(range(8, k, 8), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        h ^= h >> U(32)
        h += word[i:i + m]
        h *= U(c)
    h ^= h >> U(29)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(32)
    low = h & U(0xFFFFFFFF00000000)
    low |= np.arange(m, dtype=U)
    width, size = length - k + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if width > size:
        low = np.minimum(low[:size - width], low[width - size:])
    anchor = (low & U(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    end = np.append(start[1:], len(anchor)) + length - 1
    return h[anchor[start]], start + base, end + base


def pack(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Start (47 bits) and size (16)."""
    return (start << 16) | size


def start_of(at):
    return at >> 16


def merge_intervals(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return start[first], reach[np.append(first[1:], len(start)) - 1]


def scan_texts(length: int):
    """Rows (gram, ctx, doc, ord, at) of the contexts that occur in a batch; a
    covered interval has size 0 in ``at`` and its end in ``ctx``."""
    def flush(rows: list) -> pa.RecordBatch:
        gram, ctx, doc, nth, at = (np.concatenate(p) for p in zip(*rows))
        order = np.lexsort((at, nth, doc, ctx))
        same = np.concatenate([[False], ctx[order[1:]] == ctx[order[:-1]]])
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        moved = (doc[order] != doc[order[first]]) | (nth[order] != nth[order[first]]) | (at[order] != at[order[first]])
        gone = order[same & moved]
        keep = np.ones(len(order), bool)
        keep[order[same]] = False
        cols = [gram[keep], ctx[keep], doc[keep], nth[keep], at[keep]]
        if len(gone):
            # One number per text of the batch, so that intervals of a text merge in one go.
            start, end = start_of(at[gone]), start_of(at[gone]) + (at[gone] & 0xFFFF)
            texts, which = np.unique(np.stack([doc[gone], nth[gone]]), axis=1, return_inverse=True)
            base = which.ravel().astype(np.int64) << 33
            a, e = merge_intervals(base + start, base + end)
            t = a >> 33
            extra = [U(0x9E3779B97F4A7C15) * a.astype(U), (e - (t << 33)).astype(U), texts[0][t], texts[1][t], pack(a - (t << 33), 0)]
            cols = [np.concatenate(p) for p in zip(cols, extra)]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in cols],
                                          ["gram", "ctx", "doc", "ord", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for doc, order, text in zip(*(batch.column(c) for c in ("doc", "ord", "text"))):
                b = text.as_buffer().to_pybytes()
                if len(b) < length:
                    continue
                gram, start, end = contexts(b, length)
                ctx = np.array([digest(b[s:e]) for s, e in zip(start.tolist(), end.tolist())], U)
                rows.append((gram, ctx, np.full(len(gram), doc.as_py(), np.int64), np.full(len(gram), order.as_py(), np.int64),
                             pack(start, end - start)))
                held += len(b)
                if held >= SCAN_BYTES:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)
    return run


def sort_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (gram, ctx, doc, ord, at): covered intervals (gram
    null), and one request per different context of a gram that has several."""
    held = [np.zeros(0, np.int64)] * 5
    several = False          # the carried gram has more contexts than the carried one
    for batch in batches:
        cols = [np.asarray(batch.column(c)) for c in ("gram", "ctx", "doc", "ord", "at")]
        if not len(cols[0]):
            continue
        carried = len(held[0])
        gram, ctx, doc, nth, at = (np.concatenate(p) for p in zip(held, cols))
        ready = (at & 0xFFFF) == 0
        new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
        new_ctx = new_gram | np.concatenate([[True], ctx[1:] != ctx[:-1]]) | ready
        first = np.maximum.accumulate(np.where(new_ctx, np.arange(len(gram)), 0))
        cover = ~new_ctx & ((doc != doc[first]) | (nth != nth[first]) | (at != at[first]))
        group = np.cumsum(new_gram) - 1
        kinds = np.bincount(group, weights=new_ctx & ~ready)
        if several:
            kinds[0] = max(kinds[0], 1) + 1
        ask = new_ctx & ~ready & (kinds[group] > 1)
        if carried and several:
            ask[0] = False
        last = group == group[-1]
        tail = np.flatnonzero(last & new_ctx & ~ready)
        several_next = kinds[-1] > 1
        start = start_of(at)
        end = np.where(ready, ctx, start + (at & 0xFFFF))
        out = np.flatnonzero(cover | ready | ask)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[out]), pa.array(nth[out]), pa.array(at[out]), pa.array(end[out]), pa.array(gram[out], mask=~ask[out])],
            ["doc", "ord", "at", "end", "gram"])
        held = [c[tail[-1:]] for c in (gram, ctx, doc, nth, at)]
        several = bool(several_next) if len(tail) else False


def take_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes of the requested contexts of each text."""
    for p in batches:
        rows = []
        for doc, nth, text, asked in zip(p["doc"], p["ord"], p["text"], p["asked"]):
            b = text.encode()
            rows += [(r["gram"], doc, nth, r["at"], b[start_of(r["at"]):start_of(r["at"]) + (r["at"] & 0xFFFF)]) for r in asked]
        yield pd.DataFrame(rows, columns=["gram", "doc", "ord", "at", "bytes"])


class Suffixes:
    """Suffix array of texts held end to end, ordered by the first ``depth``
    bytes at least; a text's end is smaller than any byte."""

    def __init__(self, texts: list[bytes], depth: int):
        self.depth = depth
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.start = np.cumsum(size) - size
        self.n = int(size.sum())
        t = np.zeros(self.n + 16, np.uint8)
        t[:self.n] = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)    # ends become 0
        self.t = t
        self.end = np.repeat(self.start + size - 1, size)
        self.eight = np.ndarray((self.n + 8,), ">u8", t, strides=(1,))
        self.array = self._sort()

    def keys(self, at: np.ndarray, skip: int) -> np.ndarray:
        """The eight bytes from ``at + skip``, zero from the text's end on."""
        left = self.end[at] - at - skip
        key = self.eight[np.minimum(at + skip, self.n)].astype(U)
        short = left < 8
        if short.any():
            drop = (8 * (8 - np.maximum(left[short], 0))).astype(U)
            key[short] = np.where(drop >= 64, U(0), key[short] >> np.minimum(drop, U(63)) << np.minimum(drop, U(63)))
        return key

    def _direct(self, at: np.ndarray) -> np.ndarray:
        """Sort suffixes by eight bytes at a time, only ties going on."""
        key = self.keys(at, 0)
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        for skip in range(8, self.depth + 8, 8):
            group = np.cumsum(new)
            tied = np.flatnonzero(~new | ~np.append(new[1:], True))
            if not len(tied):
                break
            part, own = at[tied], group[tied]
            key = self.keys(part, skip)
            order = np.lexsort((key, own))
            at[tied], key = part[order], key[order]
            new[tied[1:]] |= (key[1:] != key[:-1]) & (own[1:] == own[:-1])
        return at

    def _sort(self) -> np.ndarray:
        t = self.t[:self.n]
        turn = np.append(t[:-1] != t[1:], True)
        last = np.minimum.accumulate(np.where(turn, np.arange(self.n), self.n)[::-1])[::-1]
        smaller = (t[last] < self.t[last + 1]) & (t > 0)
        direct = self._direct(np.flatnonzero(smaller)) if smaller.any() else np.zeros(0, np.int64)
        bounds = np.searchsorted(t[direct], np.arange(257))
        front: list[list[np.ndarray]] = [[] for _ in range(256)]
        done = []
        for c in range(256):
            if c == 0:
                bucket = np.flatnonzero(t == 0)
            else:
                # Suffixes larger than their successors, which came from earlier buckets, then from runs of c.
                level = np.concatenate(front[c]) if front[c] else np.zeros(0, np.int64)
                parts = []
                while len(level):
                    parts.append(level)
                    level = level[level > 0] - 1
                    level = level[t[level] == c]
                parts.append(direct[bounds[c]:bounds[c + 1]])
                bucket = np.concatenate(parts)
                front[c] = []
            if not len(bucket):
                continue
            done.append(bucket)
            before = bucket[bucket > 0] - 1
            first = t[before]
            before, first = before[first > c], first[first > c]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cut = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else []
            for i, j in zip(cut, [*cut[1:], len(first)]):
                front[first[i]].append(before[i:j])
        return np.concatenate(done)

    def common(self, at: np.ndarray) -> np.ndarray:
        """Common prefix of each suffix of the ordered list with the one
        before, counted up to ``depth``."""
        out = np.zeros(len(at), np.int64)
        live = np.arange(1, len(at))
        for skip in range(0, self.depth, 8):
            diff = self.keys(at[live], skip) ^ self.keys(at[live - 1], skip)
            equal = diff == 0
            # Leading equal bytes of the eight; an end equals nothing that counts.
            head = np.zeros(len(live), np.int64)
            head[~equal] = (64 - np.frexp(diff[~equal].astype(np.float64))[1]) // 8
            out[live] = skip + np.where(equal, 8, head)
            live = live[equal]
        room = np.minimum(self.end[at] - at, np.append(0, (self.end[at] - at)[:-1]))
        return np.minimum(np.minimum(out, room), self.depth)


def repeats_in(texts: list[bytes], length: int) -> tuple[Suffixes, np.ndarray, np.ndarray]:
    """Windows of the texts in sorted order, and whether each equals the one
    before."""
    s = Suffixes(texts, length)
    window = s.end - np.arange(s.n) >= length
    at = s.array[window[s.array]]
    return s, at, s.common(at) >= length


def sort_blocks(length: int, block_bytes: int):
    """Over contexts sorted by gram: covered intervals, and of grams that fill
    several blocks the different windows of a block (``key`` not null)."""
    def block(rows: list, spanning: set) -> pd.DataFrame:
        rows = sorted(rows, key=lambda r: r[1:4])
        s, at, equal = repeats_in([r[4] for r in rows], length)
        run = np.cumsum(~equal) - 1
        least = np.minimum.reduceat(at, np.flatnonzero(~equal)) if len(at) else at
        gone = np.sort(at[at != least[run]])
        which = np.searchsorted(s.start, gone, "right") - 1
        new = np.concatenate([[True], (gone[1:] != gone[:-1] + 1) | (which[1:] != which[:-1])]) if len(gone) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(gone)) - 1 if len(begin) else begin
        out = []
        for i, j in zip(begin, stop):
            _, doc, nth, place, _ = rows[which[i]]
            a = start_of(place) + int(gone[i] - s.start[which[i]])
            out.append((doc, nth, a << 16, a + int(gone[j] - gone[i]) + length, None, None))
        if spanning:
            which = np.searchsorted(s.start, least, "right") - 1
            for p, w in zip(least.tolist(), which.tolist()):
                gram, doc, nth, place, text = rows[w]
                if gram in spanning:
                    o = p - int(s.start[w])
                    a = start_of(place) + o
                    key = xxhash.xxh3_64_intdigest(text[o:o + length])
                    out.append((doc, nth, a << 16, a + length, key - (1 << 63), gram))
        return pd.DataFrame(out, columns=["doc", "ord", "at", "end", "key", "gram"]).astype(
            {"doc": "int64", "ord": "int64", "at": "int64", "end": "int64", "key": "Int64", "gram": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held, spanning = [], 0, set()
        for p in batches:
            for r in zip(p["gram"].tolist(), p["doc"].tolist(), p["ord"].tolist(), p["at"].tolist(), p["bytes"]):
                same = bool(rows) and r[0] == rows[-1][0]
                if held > (2 if same else 1) * block_bytes:
                    if same:
                        spanning.add(r[0])
                    yield block(rows, spanning)
                    rows, held, spanning = [], 0, spanning & {r[0]}
                rows.append(r)
                held += len(r[4])
        if rows:
            yield block(rows, spanning)
    return run


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, ord, text): ord tells apart different texts of one id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(text).alias("ord"), text.alias("text"))


def covered(rows: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc, ord, cuts): intervals of bytes to remove, per text."""
    if not 16 <= length <= 16_384:
        raise ValueError("length must lie between 16 and 16,384 bytes")
    seeds = rows.mapInArrow(scan_texts(length), "gram long, ctx long, doc long, ord long, at long")
    seeds = seeds.repartition("gram").sortWithinPartitions("gram", "ctx", "doc", "ord", "at")
    seeds = shared(seeds.mapInArrow(sort_seeds, "doc long, ord long, at long, end long, gram long"), "suffix-seeds")
    asked = seeds.where("gram is not null").groupBy("doc", "ord").agg(F.collect_list(F.struct("gram", "at")).alias("asked"))
    texts = rows.join(asked.hint("shuffle_hash"), ["doc", "ord"])
    parts = texts.select("doc", "ord", "text", "asked").mapInPandas(take_contexts, "gram long, doc long, ord long, at long, bytes binary")
    parts = parts.repartition("gram").sortWithinPartitions("gram", "doc", "ord", "at")
    found = shared(parts.mapInPandas(sort_blocks(length, block_bytes), "doc long, ord long, at long, end long, key long, gram long"), "suffix-found")
    # Windows of grams that span blocks: all but the first of equal ones.
    wide, place = found.where("key is not null"), F.struct("doc", "ord", "at")
    least = wide.groupBy("gram", "key").agg(F.min(place).alias("least"))
    later = wide.join(least, ["gram", "key"]).where(place != F.col("least"))
    cuts = seeds.where("gram is null").select("doc", "ord", "at", "end").union(
        found.where("key is null").select("doc", "ord", "at", "end")).union(later.select("doc", "ord", "at", "end"))
    return cuts.groupBy("doc", "ord").agg(F.collect_list(F.struct(F.shiftright("at", 16).alias("start"), "end")).alias("cuts"))


def kept_parts(b: bytes, cuts) -> tuple[bytes, int]:
    """What remains of a text, and the number of maximal removed runs."""
    if cuts is None or not len(cuts):
        return b, 0
    start = np.array([c["start"] for c in cuts], np.int64)
    a, e = merge_intervals(start, np.array([c["end"] for c in cuts], np.int64))
    out, at = [], 0
    for i, j in zip(a.tolist(), e.tolist()):
        out.append(b[at:i])
        at = j
    return b"".join(out) + b[at:], len(a)


def find_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    rows = numbered(docs, id_col, text_col)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for doc, text, cuts in zip(p["doc"], p["text"], p["cuts"]):
                b = text.encode()
                kept, n = kept_parts(b, cuts)
                out.append((doc, len(b), len(b) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = rows.join(covered(rows, length, block_bytes).hint("shuffle_hash"), ["doc", "ord"], "left")
    done = joined.select("doc", "text", "cuts").mapInPandas(cut, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return done.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """All rows and columns, repeated bytes cut from the text."""
    cut_doc, cut_row, cut_at = free_names(docs, "cut_doc", "cut_row", "cut_at")
    rows = numbered(docs, id_col, text_col)
    gone = covered(rows, length, block_bytes).select(F.col("doc").alias(cut_doc), F.col("ord").alias(cut_row), F.col("cuts").alias(cut_at))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or c is None else kept_parts(t.encode(), c)[0].decode(errors="ignore")
                          for t, c in zip(texts, cuts)])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.join(gone, (F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)) == F.col(cut_doc))
                       & (F.xxhash64(text) == F.col(cut_row)), "left")
    return joined.withColumn(text_col, cut(F.col(text_col), F.col(cut_at))).select(*docs.columns)
