"""Quality classifier (operator 13).

Method: histogram gradient-boosted trees over document statistics. One pass
turns every whole text into the numbers of ``STATISTICS``; those of at most
``SAMPLE_ROWS`` labelled rows (the first in a hash order of the ids) go to the
driver, where trees grow level by level on histograms of ``BINS`` quantile bins
(logistic loss, second-order gains and leaf values). The trees are flattened
into arrays of feature, border and value per node, which tasks walk for a
matrix of rows at once. Labels, language, source and id are no statistics.

Rows whose crc32(id as text) mod ``FOLDS`` is ``HELD_OUT`` give no labels.

Defined results: a null text is empty, with all statistics zero, and has a
score; equal texts have equal scores; labels other than 0 and 1 and ids with
both are left out; a null id has no label and is not held out; without any
label every score is 0.5; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_texts, nothing, shared, text_rows
from shopcast.llm.fertility import base_counts

#: Labelled rows that the trees are fitted on, at most.
SAMPLE_ROWS = 20_000
FOLDS, HELD_OUT = 4, 2
ROUNDS, DEPTH, RATE, BINS = 120, 4, 0.1, 64
#: Least sum of second derivatives in a leaf, and what is added to it.
LEAST_WEIGHT, RIDGE = 2.0, 1.0
THRESHOLD = 0.7

STATISTICS = ("log_words", "word_length", "word_length_spread", "upper_share", "capital_share", "digit_share", "symbol_share",
              "bar_share", "mark_rate", "shout_rate", "stop_rate", "next_repeat_share", "window_repeat_share", "distinct_rate",
              "top_word_share", "byte_entropy", "wide_share", "no_letter_share", "line_words", "equal_line_share", "long_word_share")

_CLASS = np.zeros((256, 6), np.int64)
for _i, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b"#*$%&|<>^~=+_{}[]@\\/", b",;:.", b"!?")):
    _CLASS[list(_bytes), _i] = 1


def statistics(text: str) -> list[float]:
    """The numbers of ``STATISTICS`` for a text."""
    b = text.encode()
    words = b.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    upper, lower, digits, symbols, marks, shouts = (count @ _CLASS).tolist()
    seen: dict[bytes, int] = {}
    numbers = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    times = np.bincount(numbers)
    distinct = list(seen)
    size = np.fromiter(map(len, distinct), np.int64, len(distinct))
    length = float((size * times).sum()) / n
    spread = math.sqrt(max(float((size * size * times).sum()) / n - length * length, 0.0))
    capital = np.fromiter((w[:1].isupper() for w in distinct), bool, len(distinct))
    letters = np.fromiter((w.lower() != w.upper() or w[0] > 127 for w in distinct), bool, len(distinct))
    _, _, equal_lines, repeated = base_counts(text, numbers)
    lines = text.count("\n") + 1
    solid = count.copy()
    solid[[9, 10, 11, 12, 13, 32]] = 0
    chars = int(solid.sum())
    share = solid[solid > 0] / chars
    return [math.log1p(n), length, spread, upper / max(upper + lower, 1), int(times[capital].sum()) / n, digits / chars, symbols / chars,
            times[seen[b"|"]] / n if b"|" in seen else 0.0, marks / n, shouts / n, count[46] / n,
            float((numbers[1:] == numbers[:-1]).sum()) / n, repeated / n, math.log1p(len(distinct)) / math.log1p(n),
            int(times.max()) / n, float(-(share * np.log2(share)).sum()), int(count[128:].sum()) / chars,
            int(times[~letters].sum()) / n, math.log1p(n / lines), equal_lines / lines, int(times[size > 20].sum()) / n]


class Trees(NamedTuple):
    """Flattened trees: node i has the children 2i+1 and 2i+2; a row goes to
    the second one where its feature is above the border."""
    feature: np.ndarray
    border: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.start)
        trees = np.arange(len(self.feature))
        if len(trees) and len(x):
            at = np.zeros((len(x), len(trees)), np.int64)
            rows = np.arange(len(x))[:, None]
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.border[trees, at])
            total = total + self.value[trees, at - (2 ** DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def borders_of(column: np.ndarray) -> np.ndarray:
    """At most ``BINS`` - 1 borders: middles between neighbouring values at quantiles."""
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS)))
    return (values[1:] + values[:-1]) / 2


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> Trees:
    """Boosted trees of rows (statistics) and labels (0 or 1)."""
    ones = float(y.sum())
    start = math.log((ones + 0.5) / (len(y) - ones + 0.5))
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    features, borders, values = [], [], []
    if 0 < ones < len(y):
        edges = [borders_of(c) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
        margin = np.full(len(y), start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            slope, curve = p - y, p * (1 - p)
            feature, border, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
            for depth in range(DEPTH):
                first, wide = 2 ** depth - 1, 2 ** depth
                sums = np.stack([np.stack([np.bincount(node * BINS + b, w, wide * BINS).reshape(wide, BINS) for w in (slope, curve)])
                                 for b in binned])
                left = np.cumsum(sums, axis=3)
                g, h = left[:, 0], left[:, 1]
                all_g, all_h = g[..., -1:], h[..., -1:]
                gain = g ** 2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g ** 2 / (all_h + RIDGE)
                gain = np.where((h >= LEAST_WEIGHT) & (all_h - h >= LEAST_WEIGHT), gain, 0.0)
                best = gain.transpose(1, 0, 2).reshape(wide, -1)
                top = best.argmax(axis=1)
                f, cut = top // BINS, top % BINS
                split = best[np.arange(wide), top] > 1e-9
                for i in np.flatnonzero(split):
                    feature[first + i], border[first + i] = f[i], edges[f[i]][cut[i]]
                node = 2 * node + (split[node] & (binned[f[node], np.arange(len(y))] > cut[node]))
            g, h = (np.bincount(node, w, leaves) for w in (slope, curve))
            value = -RATE * g / (h + RIDGE)
            margin += value[node]
            features.append(feature)
            borders.append(border)
            values.append(value)
    return Trees(np.array(features, np.int64).reshape(-1, inner), np.array(borders).reshape(-1, inner), np.array(values).reshape(-1, leaves), start)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats) of every row: the statistics as 64-bit floats."""
    def make():
        def one(keys, texts):
            return {"doc_id": keys, "stats": [np.array(statistics(t)).tobytes() for t in texts]}
        return one, nothing
    return map_texts(text_rows(docs, id_col, text_col), make, "doc_id long, stats binary")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def sample(rows: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS, id_col: str = "doc_id", label_col: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the rows to fit on."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    taken = rows.join(known.drop("other"), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "stats").limit(limit).select("stats", "label").collect()
    x = np.frombuffer(b"".join(r["stats"] for r in taken)).reshape(-1, len(STATISTICS))
    return x, np.array([r["label"] for r in taken], float)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, limit: int = SAMPLE_ROWS, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    rows = shared(measured(docs, id_col, text_col), "quality-statistics")
    trees = fit(*sample(rows, labels, limit, id_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = np.frombuffer(b"".join(part.column("stats").to_pylist())).reshape(-1, len(STATISTICS))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(trees.score(x))], ["doc_id", "score"])

    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
