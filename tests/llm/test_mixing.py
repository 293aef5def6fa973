"""Mixing (8) against plain water-filling, without Python in the plan."""

from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from brute import WORD, mix_targets
from llm_cases import SF_SMALL, docs, nothing, unchanged, wide  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shopcast.llm import mixing as m


def check(rows, got, share=1.5, most=2):
    """rows: doc_id -> (source, size); got: result rows."""
    sizes = defaultdict(int)
    for s, n in rows.values():
        sizes[s] += n
    target, taken = mix_targets(dict(sizes), share=share, most=most), defaultdict(int)
    for r in got:
        s, n = rows[r.doc_id]
        assert (r.size, r.source_size) == (n, sizes[s]) and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.repeats
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(n for x, n in rows.values() if x == s)
    assert sum(target.values()) == pytest.approx(min(share, most) * sum(sizes.values()))


def test_query_equals_water_filling(spark):
    table = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    rows = {r["doc_id"]: (r["source"], len(WORD.findall(r["text"] or ""))) for r in table}
    df = entry.queries()["op8_mixing"](spark, SF_SMALL)
    assert not any(x in df._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
    got = df.collect()
    assert len(got) == len(rows)
    check(rows, got)
    again = entry.queries()["op8_mixing"](spark, SF_SMALL).collect()
    assert sorted(got) == sorted(again)


def test_hot_source_caps_and_odd_names(spark):
    rows = {i: (("big", "é", "Z", "z", None, "\U0001F600")[0 if i < 300 else i % 6], 1 + i * 7 % 40) for i in range(420)}
    df = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, (s, n) in rows.items()], "doc_id long, text string, source string")
    for share in (0.3, 1.0, 1.5, 3.0):
        check(rows, m.plan_rows(df.repartition(5), share=share).collect(), share=share)


def test_many_sources_fill_in_several_rounds(spark):
    rows = {i: (f"s{i % 40:02d}", 1 + (i % 40) ** 3 // 50) for i in range(400)}
    df = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in rows.items()], "doc_id long, text string, source string")
    check(rows, m.plan_rows(df).collect())


def test_order_of_sources_is_by_code_point(spark):
    rows = spark.createDataFrame([("é", 1), ("Z", 1), (None, 1), ("z", 1), ("\U0001F600", 1), ("ａ", 1)], "source string, size long")
    got = [(r.source, r.weight) for r in m.by_source(rows, (3, 1, 2)).orderBy(F.col("source").asc_nulls_last()).collect()]
    assert got == [("Z", 3.0), ("z", 1.0), ("é", 2.0), ("ａ", 3.0), ("\U0001F600", 1.0), (None, 2.0)]


def test_defined_results(docs, wide, nothing):
    got = m.plan_rows(wide).collect()
    assert len(got) == docs.count() and all(r.size == 0 == r.taken for r in got if r.doc_id in (4, 5, 6))
    assert len({r.taken for r in got if r.doc_id == 14}) == 1
    out = m.mix(wide)
    assert out.columns == wide.columns and unchanged(out)
    times = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    plan = Counter()
    for r in got:
        plan[(r.doc_id, r.size)] += r.repeats
    assert sum(times.values()) == sum(plan.values())
    assert m.plan_rows(nothing).collect() == [] and m.mix(nothing).collect() == []
    blank = docs.where("doc_id in (4, 5, 6)")
    assert {r.taken for r in m.plan_rows(blank).collect()} == {0} and {r.target for r in m.plan_rows(blank).collect()} == {0.0}
