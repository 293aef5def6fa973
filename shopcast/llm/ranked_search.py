"""Ranked lexical search (operator 11).

Method: K2-treap over the term-document grid. A task takes its documents in
blocks; the cells of a block (row: a term of the items, column: a document,
value: what the term adds to the document's score) become a compressed
quadtree: of every square of the grid that holds a cell it keeps four bits,
which quarters hold cells, the place of the first one, and the largest value
inside. For an item the squares of its rows descend together, best first: a
range of documents is bounded by the sum of its rows' maxima, halves of the
ranges with the highest bounds come next, single documents give their exact
score, and ranges below the k-th best score are left. Rows are ordered by
document frequency, so that neighbours in a square weigh alike.

Terms are runs of ASCII letters, digits and characters beyond ASCII, only A-Z
lower-cased. The score of a document is the integer formula of ``impacts``,
summed over the item's different terms; corpus counts cover all documents.

Scale: items go in blocks of about ``ITEM_BYTES`` of different terms, each
against all documents; only such a block's terms and weights are broadcast. A
task holds one block of at most ``CELLS`` cells (or one document) and the best
k of each item, and hands on those; they merge in two steps, so no task sees
more than ``MERGE`` tasks' results of an item at once.

Defined results: null and empty texts have no terms: such documents count
nowhere, such items have no rows; items without a hit have no rows; rows of
one item id are one item; every document row ranks by itself, also when ids
repeat; a null doc_id stands after others of the same score; empty tables give
an empty result; other columns are ignored. Texts are never cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcast.llm.common import shared, text_rows

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of different terms of the items that one scan of the documents serves.
ITEM_BYTES = 4 << 20
#: Columns and cells of a block.
COLUMNS, CELLS = 8192, 1 << 20
#: Ranges that open at once: first and at most.
FIRST_RANGES, MOST_RANGES = 32, 512
#: Tasks whose results of an item merge in one step.
MERGE = 512
NULL_ID = np.iinfo(np.int64).max

_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Place of quarter q among the quarters in a set of bits, or -1.
_PLACE = np.array([[bin(bits & ((1 << q) - 1)).count("1") if bits >> q & 1 else -1 for q in range(4)] for bits in range(16)], np.int32).ravel()


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    return text.encode().translate(_SPLIT).split()


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What occurrences of terms add to the scores of documents of ``n`` terms."""
    m = 50 + (50 * n * docs) // terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def term_weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits, each followed by a zero bit."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class K2Treap:
    """Quadtree over the cells (row, column, value) of a block. Square 0 stands
    for those without a cell, square 1 is the whole grid."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, side: int):
        self.height = max(int(side - 1).bit_length(), 1)
        z = (_spread(row) << np.uint64(1)) | _spread(col)
        order = np.argsort(z)
        key, most = z[order], value[order]
        levels = [(key, most, np.zeros(len(key), np.uint8), np.zeros(len(key), np.int32))]
        for _ in range(self.height):
            parent = key >> np.uint64(2)
            start = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            bits = np.bitwise_or.reduceat(np.uint8(1) << (key & np.uint64(3)).astype(np.uint8), start)
            key, most = parent[start], np.maximum.reduceat(most, start)
            levels.append((key, most, bits, start.astype(np.int32)))
        levels.reverse()
        at, first = 1, []
        for i, (_, _, _, start) in enumerate(levels):
            at += len(start)
            first.append(start + at if i < self.height else start)
        zero = np.zeros(1, np.int32)
        self.most = np.concatenate([zero.astype(np.int64), *[x[1] for x in levels]])
        self.bits = np.concatenate([zero.astype(np.int32), *[x[2].astype(np.int32) << 2 for x in levels]])
        self.first = np.concatenate([zero, *first]).astype(np.int32)

    def best(self, rows: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, columns) of the ``k`` best columns by the sum of ``rows``,
        of those that score ``floor`` or more; equal scores by column."""
        rows = rows.astype(np.int32)
        bound = np.array([int(self.most[1]) * len(rows)])
        level, col = np.zeros(1, np.int32), np.zeros(1, np.int64)
        squares = np.ones((1, len(rows)), np.int32)
        scores, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = FIRST_RANGES
        while len(bound):
            if len(bound) > size:
                pick = np.argpartition(bound, len(bound) - size)[len(bound) - size:]
                rest = np.ones(len(bound), bool)
                rest[pick] = False
            else:
                pick, rest = slice(None), np.zeros(len(bound), bool)
            size = min(2 * size, MOST_RANGES)
            at, half = level[pick] + 1, squares[pick]
            quarter = self.bits[half] + (((rows[None, :] >> (self.height - at)[:, None]) & 1) << 1)
            first = self.first[half]
            opened = []
            for side in (0, 1):
                place = _PLACE[quarter + side]
                child = np.where(place >= 0, first + place, 0)
                total = self.most[child].sum(axis=1)
                opened.append((total, at, 2 * col[pick] + side, child))
            total, at, new, child = (np.concatenate(x) for x in zip(*opened))
            done = (at == self.height) & (total >= floor)
            if done.any():
                scores, columns = np.concatenate([scores, total[done]]), np.concatenate([columns, new[done]])
                if len(scores) > k:
                    top = np.lexsort((columns, -scores))[:k]
                    scores, columns = scores[top], columns[top]
                if len(scores) == k:
                    floor = max(floor, int(scores.min()))
            more = (at < self.height) & (total >= floor)
            rest &= bound >= floor
            bound, level, col, squares = (np.concatenate([old[rest], x[more]]) for old, x in (
                (bound, total), (level, at), (col, new), (squares, child)))
        top = np.lexsort((columns, -scores))
        return scores[top], columns[top]


def hits(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tf) of documents with terms: ``n`` counts all, terms
    and occurrences are arrays of 32-bit numbers of those in the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            out = {"doc_id": [], "n": [], "terms": [], "tf": []}
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = terms_of(text)
                if words:
                    found, tf = np.unique(np.array([i for i in map(get, words) if i is not None], np.int32), return_counts=True)
                    for name, v in zip(out, (doc, len(words), found.tobytes(), tf.astype(np.int32).tobytes())):
                        out[name].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], list(out))

    return text_rows(docs, id_col, text_col).mapInArrow(scan, "doc_id long, n long, terms binary, tf binary")


def frequencies(found: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    rows = found.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(terms, np.int64)
    out[[r["term"] for r in rows]] = [r["df"] for r in rows]
    return out


def blocks(batches: Iterator[pa.RecordBatch], columns: int, most: int) -> Iterator[list[tuple]]:
    """(id, length, terms, occurrences) of documents, in blocks of so many
    columns and cells at most, or of one document."""
    held, cells = [], 0
    for batch in batches:
        for doc, n, terms, tf in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "terms", "tf"))):
            if not terms:
                continue
            if held and (len(held) == columns or cells + len(terms) // 4 > most):
                yield held
                held, cells = [], 0
            held.append((NULL_ID if doc is None else doc, n, terms, tf))
            cells += len(terms) // 4
    if held:
        yield held


def best_of_tasks(found: DataFrame, items: list[tuple[int | None, list[int]]], weights: np.ndarray, row_of: np.ndarray,
                  docs: int, terms: int, k: int) -> DataFrame:
    """(item_id, doc_id, score, part): the k best of each task's documents for
    each item. ``items``: (item id, terms)."""
    given = found.sparkSession.sparkContext.broadcast((items, weights, row_of))
    columns, cells, merge = COLUMNS, CELLS, MERGE

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        items, weights, row_of = given.value
        wanted = [row_of[np.array(t, np.int64)] for _, t in items]
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)
        for held in blocks(batches, columns, cells):
            held.sort(key=lambda r: r[0])
            ids, n = (np.array([r[i] for r in held], np.int64) for i in (0, 1))
            col = np.repeat(np.arange(len(held)), [len(r[2]) // 4 for r in held])
            term = np.frombuffer(b"".join(r[2] for r in held), np.int32)
            tf = np.frombuffer(b"".join(r[3] for r in held), np.int32).astype(np.int64)
            value = impacts(weights[term], tf, n[col], docs, terms)
            some = value > 0
            if not some.any():
                continue
            tree = K2Treap(row_of[term[some]], col[some], value[some], max(len(weights), len(held)))
            for i, rows in enumerate(wanted):
                scores, found_ids = top[i]
                new, at = tree.best(rows, k, int(scores[-1]) if len(scores) == k else 1)
                if len(new):
                    scores, found_ids = np.concatenate([scores, new]), np.concatenate([found_ids, ids[at]])
                    order = np.lexsort((found_ids, -scores))[:k]
                    top[i] = scores[order], found_ids[order]
        part = TaskContext.get().partitionId() // merge
        for (item, _), (scores, found_ids) in zip(items, top):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(scores), pa.int64()), pa.array(found_ids, mask=found_ids == NULL_ID),
                                                  pa.array(scores), pa.array([part] * len(scores), pa.int64())],
                                                 ["item_id", "doc_id", "score", "part"])

    return found.mapInArrow(search, "item_id long, doc_id long, score long, part long")


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, term, block): different terms of the items, in blocks."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    rows = items.select(F.col(item_col).cast("long").alias("item_id"), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))).alias("term"))
    rows = shared(rows.distinct(), "search-items")
    size = rows.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    return rows.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(-(-size // ITEM_BYTES))))


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    asked = item_terms(items, item_col, item_text_col)
    out = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long, part long")
    for (block,) in sorted(asked.select("block").distinct().collect()):
        pairs = asked.where(F.col("block") == block).groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        names = sorted({t for r in pairs for t in r["terms"]})
        number = {t: i for i, t in enumerate(names)}
        found = shared(hits(docs, {t.encode(): i for t, i in number.items()}, id_col, text_col), "search-hits")
        n_docs, n_terms = found.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        df = frequencies(found, len(names))
        weights = np.array([term_weight(n_docs, int(x)) for x in df], np.int64)
        row_of = np.argsort(np.argsort(df, kind="stable"), kind="stable")
        batch = [(r["item_id"], [number[t] for t in r["terms"]]) for r in pairs]
        out = out.unionByName(shared(best_of_tasks(found, batch, weights, row_of, n_docs, n_terms, k), "search-best"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).where(F.col("rank") <= k)
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return out.select("item_id", "rank", "doc_id", "score")
