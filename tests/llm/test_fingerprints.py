"""Fingerprints (7) against exact similarity, without Python in the plan."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import jaccard, sha, shingles
from llm_cases import SF_SMALL, docs, nothing, wide  # noqa: F401

import __spark_entry__ as entry
from shopcast.llm import fingerprints as f


def pairs(rows):
    """doc_id -> (text, edited text, next text)."""
    rows = sorted(((r["doc_id"], r["text"] or "") for r in rows))
    out = {}
    for i, (d, t) in enumerate(rows):
        n, nxt = len(t) // 4, rows[(i + 1) % len(rows)][1]
        out[d] = (t, t[:len(t) - n] + nxt[:n], nxt)
    return out


def test_query_edits_and_estimates(spark):
    want = pairs(pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist())
    df = entry.queries()["op7_fingerprints"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    got, errors = df.collect(), []
    assert len(got) == len(want)
    for r in got:
        t, edited, nxt = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited))
        s = shingles(t.lower())
        errors += [r.near_edited - jaccard(s, shingles(edited.lower())), r.near_next - jaccard(s, shingles(nxt.lower()))]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06 and np.abs(errors).max() < 0.3


def test_blocks_of_any_size_give_the_same_next_row(spark, monkeypatch):
    ids = [5, -3, 10 ** 12, 7, 8, 9, 2_000_000, 2_000_001, 11]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, "n")], "doc_id long, text string").repartition(3)
    order = ["n"] + [f"t{i}" for i in sorted(ids)]
    for block, top in ((2048, 1024), (1, 2), (3, 1)):
        monkeypatch.setattr(f, "BLOCK", block)
        monkeypatch.setattr(f, "SUPER", top)
        got = {r.text: r.next_text for r in f.with_next(df).collect()}
        assert got == dict(zip(order, order[1:] + order[:1]))


def test_probes_reach_all_bins():
    seen = {(b, r): f.probe(b, r) for b in range(f.BINS) for r in range(f.ROUNDS)}
    assert set(seen.values()) == set(range(f.BINS))


def test_defined_results(docs, wide, nothing):
    got = f.edited_pairs(wide).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == by[2][0].fingerprint != by[3][0].fingerprint
    assert len({r.fingerprint for r in by[14]}) == 1 and by[8][0].fingerprint == by[9][0].fingerprint
    assert [by[i][0].fingerprint for i in (4, 5, 6)] == ["", "", ""] and by[4][0].near_next == 1.0 and by[6][0].near_next == 0.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert {r.doc_id: r.fingerprint for r in f.fingerprint(docs).collect()}[1] == by[1][0].fingerprint
    assert len(by[1][0].fingerprint) == 64 * f.BINS // f.PER_LONG // 4
    assert f.edited_pairs(nothing).collect() == [] and f.fingerprint(nothing).collect() == []


def test_a_lone_document_is_its_own_next(spark):
    text = " ".join(f"w{i}" for i in range(100))
    r = f.edited_pairs(spark.createDataFrame([(3, text)], "doc_id long, text string")).collect()[0]
    n = len(text) // 4
    assert r.edited_sha256 == sha(text[:len(text) - n] + text[:n]) and r.near_next == pytest.approx(1.0)
