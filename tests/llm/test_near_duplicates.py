"""HyperMinHash near-duplicates (2) against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from brute import jaccard, near_components, shingles
from llm_cases import SF_SMALL, docs, nothing, unchanged, wide, words  # noqa: F401

import __spark_entry__ as entry
from shopcast.llm import hyperminhash as h
from shopcast.llm.shingles import overlap, shingle_set, similar


def test_sets_equal_plain_shingles():
    r = random.Random(1)
    for _ in range(400):
        a, b = ("".join(r.choice("abAé \t\n\x0b\x85") for _ in range(r.randint(0, 80))) for _ in range(2))
        x, y = shingle_set(a), shingle_set(b)
        assert len(x) == len(shingles(a)) and overlap(x, y) == len(shingles(a) & shingles(b))
    assert similar(shingle_set("a b"), shingle_set("A  B")) and not similar(shingle_set("a b"), shingle_set("ab"))


def test_estimate_is_unbiased():
    r, errors = np.random.default_rng(3), []
    for _ in range(300):
        n = int(r.integers(40, 900))
        a = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = np.concatenate([a[:int(n * 0.8)], r.integers(0, 1 << 63, n // 8, dtype=np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(h.estimate(h.registers(np.unique(a)), h.registers(np.unique(b))) - true)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.09


def test_bands_find_pairs_at_the_threshold():
    r, met = np.random.default_rng(5), 0
    for i in range(400):
        n = (8, 20, 60, 400)[i % 4]
        union = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        k = len(union) // 8
        a, b = np.sort(union[k:]), np.sort(np.concatenate([union[:k], union[2 * k:]]))
        met += bool(keys_of(a) & keys_of(b))
    assert met == 400


def keys_of(s, percent=75, frequencies=h.Frequencies(np.zeros(0, np.uint64), np.zeros(0, np.int64))):
    """All candidate keys of a set."""
    keys = h.band_keys(h.registers(s)).tolist()
    return set(keys + (h.prefix_keys(s, frequencies, percent).tolist() if h.has_prefix(len(s), percent) else []))


def test_densified_registers_err_little():
    """Standard error of the estimate at small unions (share of equal registers)."""
    r = np.random.default_rng(8)
    for n in (10, 20, 40, 160):
        errors = []
        for _ in range(300):
            union = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            a, b = union[:-max(n // 10, 1)], r.permutation(union)[max(n // 10, 1):]
            a, b = np.sort(a), np.sort(b)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(h.estimate(h.registers(a), h.registers(b)) - true)
        assert np.std(errors) < 0.12 * (true * (1 - true) / 0.25) ** 0.5 + 0.03, n


def test_query_equals_all_pairs(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = near_components([(r["doc_id"], r["text"]) for r in rows])
    got = entry.queries()["op2_hyperminhash"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_groups_chains_and_blocks(spark, monkeypatch):
    """A hub with many unlike copies, a chain whose ends are unlike, and exact
    copies; small blocks, so outside nodes meet members across blocks."""
    r = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))] + [(i, " ".join(base)) for i in range(1, 30)]
    for i in range(30, 150):
        w = list(base)
        for k in r.sample(range(120), 3):
            w[k] = f"n{i}x{k}"
        rows.append((i, " ".join(w)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(150, 160):
        rows.append((i, " ".join(chain)))
        at = (i - 150) * 9
        chain[at:at + 5] = [f"z{i}k{k}" for k in range(5)]
    monkeypatch.setattr(h, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in h.near_duplicates(df).collect()}
    assert got == near_components(rows)


def test_components_spread_along_long_paths(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 7), (200, 100)] + [(300, k) for k in range(301, 340)]
    out = h.components(spark.createDataFrame(links, "a long, b long"), "test")
    got = {r.node: r.component for r in out.collect()}
    assert got == {i: 100 for i in range(100, 161)} | {5: 5, 9: 5, 7: 5, 200: 100} | {300: 300} | {k: 300 for k in range(301, 340)}


def test_blocks_find_what_hubs_missed(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK", 4)
    base = {i: shingle_set(" ".join([f"w{k}" for k in range(100)] + [f"own{i}"])) for i in range(30)}
    base[50], base[51] = shingle_set(words(90, 5)), shingle_set(" ".join([f"w{k}" for k in range(88)] + [f"z{k}" for k in range(12)]))
    comp = {i: 0 if i < 12 else 12 if i < 20 else i for i in base}
    rows = []
    for i, s in base.items():
        r = h.registers(s)
        rows += [(int(k), i, h.BAND, comp[i], 0, len(s), r.tobytes(), s.tobytes()) for k in h.band_keys(r)]
    df = spark.createDataFrame(rows, "key long, node long, at int, component long, main long, n_shingles long, "
                                     "registers binary, set binary")
    near = {(a, b) for a in base for b in base if a < b and similar(base[a], base[b])}
    keys = {(r.key, r.node) for r in h.plausible_rows(df.drop("set"), 75).collect()}
    by_key = {}
    for k, n in keys:
        by_key.setdefault(k, set()).add(n)
    shared_key = {(a, b) for g in by_key.values() for a in g for b in g if a < b}
    assert {p for p in near if comp[p[0]] != comp[p[1]]} <= shared_key and not any(50 in p for p in shared_key)
    for meet in (h.linked_in_blocks, h.linked_in_small_blocks):
        links = {(r.a, r.b) for r in meet(df, 75).collect()}
        assert links <= near
        for a, b in near:
            if comp[a] != comp[b] and comp[b]:
                # A node outside the main component has a link to each other component that it is near to.
                assert any(b in p and comp[p[0] if p[1] == b else p[1]] == comp[a] for p in links)


def test_defined_results(docs, wide, nothing):
    got = h.near_duplicates(wide).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == docs.count()
    assert [by[i][0].component_id for i in (1, 2, 3, 4, 5, 6)] == [1, 1, 1, 4, 5, 6]
    assert by[9][0].component_id == 8 and by[8][0].kept and not by[9][0].kept and by[8][0].n_shingles == 1
    assert [r.n_shingles for r in by[4] + by[5] + by[6]] == [0, 0, 0]
    assert [r.component_id for r in by[14]] == [14, 14] and all(r.component_id is None and r.kept for r in by[None])
    assert jaccard(shingles(words(120, 1)), shingles(words(120, 1) + "\n" + words(30, 16))) > 0.75 and by[16][0].component_id == 1
    kept = h.deduplicate(wide)
    assert kept.columns == wide.columns and unchanged(kept)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 13, 14, None, None]))
    assert h.near_duplicates(nothing).collect() == [] and h.deduplicate(nothing).collect() == []


def test_small_similar_sets_always_share_a_key():
    r = np.random.default_rng(6)
    for i in range(6000):
        n = 1 + i % 90
        union = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        drop = int(r.integers(0, n // 4 + 1))
        a = int(r.integers(0, drop + 1))
        order = r.permutation(union)
        x, y = np.sort(order[a:]), np.sort(np.concatenate([order[:a], order[drop:]]))
        counted = r.permutation(union)[:int(r.integers(0, n + 1))]
        table = h.Frequencies(np.sort(counted), r.integers(8, 12, len(counted)))
        if min(len(x), len(y)) <= h.SMALL and similar(x, y):
            a, b = (h.prefix_keys(s, table).tolist() for s in (x, y))
            first = next((k for k in a if k in b), None)
            assert first is not None, (len(x), len(y))
            # The first common key passes the filter by places.
            assert min(len(x) - a.index(first), len(y) - b.index(first)) >= h.least_overlap(len(x), len(y), 75)


def test_sorted_rows_meet_their_first_node():
    r = np.random.default_rng(12)
    for _ in range(200):
        rows = sorted({(int(k), int(n)) for k, n in zip(r.integers(0, 6, 30), r.integers(0, 9, 30))})
        rows = sorted(rows + [rows[i] for i in r.integers(0, len(rows), 4)])
        at = np.sort(r.integers(0, len(rows) + 1, 4))
        batches = [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*[(*q, 7) for q in part]), (pa.int64(), pa.int64(), pa.int32()))],
                                              ["key", "node", "at"]) if part else
                   pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32())], ["key", "node", "at"])
                   for part in (rows[i:j] for i, j in zip([0, *at], [*at, len(rows)]))]
        out = [tuple(x.values()) for b in h.meeting_rows(iter(batches)) for x in b.to_pylist()]
        first = {}
        for k, n in rows:
            first.setdefault(k, n)
        several = {k for k, n in rows if n != first[k]}
        assert sorted(x for x in out if not x[4]) == sorted({(k, n, 7, first[k], False) for k, n in rows if k in several})
        assert {x[:2] for x in out if x[4]} == {(k, first[k]) for k in (rows[0][0], rows[-1][0])}


def test_a_line_common_to_many_short_documents(spark):
    """The line is no key of them, so no key holds more than a few documents."""
    line = " ".join(f"c{i}" for i in range(12))
    rows = [(i, f"{line}\n{words(14 + i % 9, i)}") for i in range(1500)] + [(5000 + i, f"{line}\n{words(14 + i % 9, i)} end") for i in range(0, 1500, 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    nodes = h.signatures(df).withColumnRenamed("doc_id", "id")
    table = h.frequent_shingles(nodes)
    assert sorted(table.counts.tolist())[-8:] == [1530] * 8
    keys = h.candidate_keys(nodes, table, 75).where("at >= 0").groupBy("key").count().agg({"count": "max"}).first()[0]
    assert keys <= 4
    got = {x.doc_id: x.component_id for x in h.near_duplicates(df).collect()}
    assert got == {i: i if i < 5000 else i - 5000 for i, _ in rows}


def test_short_documents_equal_all_pairs(spark, monkeypatch):
    """Pairs of short texts at the threshold; blocks, too, keep pairs without a band."""
    rows = []
    for i in range(1200):
        n = 7 + i % 19
        w = words(n, i).split()
        # One end changed: unlike shingles as many as the threshold allows.
        cut = (n - 4 + 1) // 7
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:n - cut] + [f"end{i}x{k}" for k in range(cut)]))]
    monkeypatch.setattr(h, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.component_id for x in h.near_duplicates(df).collect()}
    want = {}
    for i in range(1200):
        a, b = (shingles(t) for _, t in rows[2 * i:2 * i + 2])
        want |= {2 * i: 2 * i, 2 * i + 1: 2 * i if jaccard(a, b) >= 0.75 else 2 * i + 1}
    assert sum(k != v for k, v in want.items()) > 500 and got == want
