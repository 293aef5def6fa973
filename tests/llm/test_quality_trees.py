"""Quality classifier: held-out accuracy, flattened trees, edge rows."""

import zlib

import numpy as np
import pytest
from llm_cases import docs, nothing, unchanged, wide  # noqa: F401
from pyspark.sql import functions as F

from shopcast.llm import quality_trees as qt

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = qt.classify(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == 1000
    rows = out.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["score"], r["predicted"], r["quality"]) for r in rows if r["held_out"]]
    good, bad = ([s for s, _, q in held if q == v] for v in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in good for b in bad]) > 0.97
    assert np.mean([p == q for _, p, q in held]) > 0.95


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = qt.held_out()
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, qt.classify(docs, x).collect())) for x in (labels, other))
    assert a == b


def test_edge_documents(spark, docs, wide, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (7, 1, 1), (11, 0, 0), (13, 0, 0), (14, 0, 0), (14, 1, 0), (16, None, 0), (None, 1, 0),
                                    (2, 5, 0)], "doc_id long, quality int, toxic int")
    rows = sorted(map(tuple, qt.classify(docs, labels).collect()), key=repr)
    assert len(rows) == docs.count() and rows == sorted(map(tuple, qt.classify(wide, labels).collect()), key=repr)
    by_id = {}
    for doc, held, score, _ in rows:
        by_id.setdefault(doc, set()).add(score)
        assert 0 <= score <= 1 and (doc is not None or not held)
    assert len(by_id[1] | by_id[2]) == 1 and len(by_id[4] | by_id[5] | by_id[6]) == 1 and len(by_id[14]) == 1
    assert qt.classify(nothing, labels).count() == 0
    assert {(r["score"], r["predicted"]) for r in qt.classify(docs, labels.limit(0)).collect()} == {(0.5, 0)}
    one = qt.classify(docs, labels.where("quality = 1")).collect()
    assert len({r["score"] for r in one}) == 1 and one[0]["score"] > 0.5


def test_walk_equals_one_node_at_a_time():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, len(qt.STATISTICS)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = qt.fit(x, y, rounds=20)
    for row, score in zip(x, trees.score(x)):
        total = trees.start
        for f, border, value in zip(trees.feature, trees.border, trees.value):
            i = 0
            while i < 2 ** qt.DEPTH - 1:
                i = 2 * i + (2 if row[f[i]] > border[i] else 1)
            total += value[i - (2 ** qt.DEPTH - 1)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)
    assert ((trees.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_sample_is_bounded(spark):
    rows = spark.createDataFrame([(i, np.full(len(qt.STATISTICS), float(i)).tobytes()) for i in range(60)], "doc_id long, stats binary")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    x, y = qt.sample(rows, labels, 10)
    assert len(x) == len(y) == 10 and ((x[:, 0].astype(int) % 2) == y).all()
    again, _ = qt.sample(rows.repartition(7), labels, 10)
    assert (again == x).all()
