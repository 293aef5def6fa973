"""Ranked search against brute force over all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import CLASHES, docs, nothing, wide, words  # noqa: F401

from shopcast.llm import ranked_search as rs

FOLD = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return re.findall(rs.TERM, (text or "").translate(FOLD))


def brute(rows, items, k=50):
    held = [(doc, Counter(terms(text))) for doc, text in rows]
    held = [(doc, c, sum(c.values())) for doc, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, want in wanted.items():
        found = []
        for doc, c, n in held:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in want if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def answer(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_edge_documents_and_items(spark, docs, wide, nothing):
    asked = [(0, words(3, 1) + " HERE, Same"), (1, None), (2, "..."), (3, "漢字 é one"), (3, "again one"), (None, words(2, 15)), (9, "nowhere")]
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], asked)
    items = items_of(spark, asked)
    assert answer(rs.search(docs, items)) == want and {r[0] for r in want} == {0, 3, None}
    assert answer(rs.search(wide, items.withColumn("term", items.text).withColumn("block", items.text))) == want
    assert answer(rs.search(nothing, items)) == [] and answer(rs.search(docs, items.limit(0))) == []


@pytest.mark.parametrize("columns, cells, item_bytes, merge", [(8192, 1 << 20, 4 << 20, 512), (7, 40, 60, 1)])
def test_ties_blocks_and_repeats(spark, monkeypatch, columns, cells, item_bytes, merge):
    for name, v in (("COLUMNS", columns), ("CELLS", cells), ("ITEM_BYTES", item_bytes), ("MERGE", merge)):
        monkeypatch.setattr(rs, name, v)
    rng = np.random.default_rng(5)
    rows = [(int(i), " ".join(f"t{int(x)}" for x in rng.zipf(1.5, rng.integers(1, 25)) % 60)) for i in rng.permutation(300)]
    rows += [(i, "t1 t2 t3") for i in range(300, 400)] + [(7, "t1 t2 t3")] * 3
    asked = [(i, " ".join(f"t{int(x)}" for x in rng.integers(0, 70, 8))) for i in range(12)] + [(99, "t1 t3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(rs.search(docs, items_of(spark, asked), 20)) == brute(rows, asked, 20)


def test_treap_gives_the_best_columns():
    rng = np.random.default_rng(1)
    for _ in range(40):
        rows, cols = int(rng.integers(1, 40)), int(rng.integers(1, 90))
        grid = np.where(rng.random((rows, cols)) < 0.3, rng.integers(1, 9, (rows, cols)), 0)
        if not grid.any():
            continue
        r, c = np.nonzero(grid)
        tree = rs.K2Treap(r, c, grid[r, c], max(rows, cols))
        pick = np.unique(rng.integers(0, rows, 5))
        total, k = grid[pick].sum(axis=0), int(rng.integers(1, 12))
        want = [(-s, i) for s, i in sorted((-int(s), i) for i, s in enumerate(total) if s > 0)[:k]]
        assert list(zip(*(x.tolist() for x in tree.best(pick, k, 1)))) == want
