"""Suffix-array dedup (1) against a set of all windows."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from brute import repeats, sha
from llm_cases import SF_SMALL, docs, nothing, unchanged, wide  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shopcast.llm import suffix_dedup as s


def test_suffix_array_and_common_prefixes():
    r = random.Random(5)
    for i in range(200):
        texts = [bytes(r.choice(b"ab\0c" if i % 2 else b"abcdefgh") for _ in range(r.randint(0, 80))) for _ in range(r.randint(1, 6))]
        a = s.Suffixes(texts, 16)
        owner = [max(k for k in range(len(texts)) if a.start[k] <= p) for p in a.array]
        suffixes = [texts[k][p - a.start[k]:] for k, p in zip(owner, a.array)]
        assert len(set(a.array.tolist())) == a.n == sum(len(t) + 1 for t in texts)
        common = a.common(a.array)
        for j in range(1, a.n):
            x, y = suffixes[j - 1][:16], suffixes[j][:16]
            assert x <= y
            assert common[j] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_contexts_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(s, "STARTS", 64)
    r = random.Random(6)
    for n in (15, 16, 17, 100, 500):
        b = bytes(r.choice(b"ab") for _ in range(n))
        _, start, end = s.contexts(b, 16)
        assert [x for a, e in zip(start, end) for x in range(a, e - 15)] == list(range(max(0, n - 15)))


def made(seed, alphabet):
    r = random.Random(seed)
    base, out = "".join(r.choice(alphabet) for _ in range(300)), []
    for i in range(60):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 120)))
        for _ in range(r.randint(0, 3)):
            a = r.randint(0, 280)
            t += base[a:a + r.randint(1, 60)] + "".join(r.choice(alphabet) for _ in range(5))
        out.append((r.randint(0, 10 ** 6) * 60 + i, None if r.random() < 0.05 else t))
    return out


def test_equals_all_windows_with_small_blocks(spark):
    for seed, alphabet, block in ((1, "ab", 1 << 20), (2, "abcdefghij é", 1 << 20), (3, "ab", 300), (4, "abcd", 500)):
        rows = made(seed, alphabet)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = {r.doc_id: tuple(r)[1:] for r in s.find_repeats(df, 16, block_bytes=block).collect()}
        assert got == repeats(rows, 16)


def test_query_equals_all_windows(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op1_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == repeats([(r["doc_id"], r["text"]) for r in rows], 100)


def test_many_texts_of_one_id_or_none(spark):
    """More texts of one id, and without one, than any order in few bits holds;
    the brute force numbers them by the hash that orders them."""
    n = 40_000
    text = [f"{i} " + "".join(random.Random(i % 3000).choice("abcdefgh") for _ in range(30)) for i in range(n)]
    rows = [(None if i % 2 else 7, t) for i, t in enumerate(text)] + [(8, text[0]), (10 ** 15, text[1]), (6, text[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = {(r.doc_id, r.text): (-1 if r.doc_id is None else r.doc_id, r.h) for r in df.withColumn("h", F.xxhash64("text")).collect()}
    number = {k: i for i, k in enumerate(sorted(order, key=order.get))}
    want = repeats([(number[k], k[1]) for k in order], 20)
    got = sorted(tuple(r) for r in s.find_repeats(df, 20).select(F.coalesce("doc_id", F.lit(-1)), "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == sorted((order[k][0], *want[number[k]]) for k in order) and sum(r[2] for r in got) > 0


def test_defined_results(docs, wide, nothing):
    got = s.find_repeats(wide).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_removed == 0 and by[2][0].n_removed == by[2][0].n_bytes and by[2][0].n_spans == 1
    assert by[4][0].n_bytes == 0 and by[4][0].kept_sha256 == by[5][0].kept_sha256 == sha(b"")
    # A run of one letter keeps its first string of 100 and nothing of what starts later but that string.
    assert by[11][0].n_removed == 2999 and by[11][0].n_spans == 1
    assert [r.n_removed for r in by[14]] == [0, 0]
    assert by[16][0].n_removed > 0 and sorted(r.n_bytes for r in by[None])[0] == 0
    assert s.find_repeats(nothing).collect() == []
    out = s.remove_repeats(wide)
    assert out.columns == wide.columns and out.count() == docs.count() and unchanged(out)
    kept = {r.doc_id: r.text for r in out.collect() if r.doc_id in (1, 2, 4, 11)}
    assert kept[2] == "" and kept[4] is None and kept[11] == "a"
    assert s.remove_repeats(nothing).collect() == []


def split(batch, sizes):
    at = 0
    for n in sizes:
        yield batch.slice(at, n)
        at += n
    yield batch.slice(at)


def test_seeds_do_not_depend_on_batches():
    r = np.random.default_rng(8)
    for case in range(60):
        n = int(r.integers(1, 60))
        rows = sorted({(int(r.integers(0, 6)), int(r.integers(0, 4)), int(r.integers(0, 5)), int(r.integers(-1, 2)), int(r.integers(0, 9)) << 16 | 100)
                       for _ in range(n)})
        rows += [(9, 500 + i, i, 0, i << 16) for i in range(case % 3)]
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["gram", "ctx", "doc", "ord", "at"])
        whole = [tuple(x.values()) for b in s.sort_seeds([batch]) for x in b.to_pylist()]
        sizes = [int(r.integers(0, 4)) for _ in range(n)]
        parts = [tuple(x.values()) for b in s.sort_seeds(split(batch, sizes)) for x in b.to_pylist()]
        assert sorted(parts, key=repr) == sorted(whole, key=repr)
        first, want = {}, []
        for g, c, d, o, at in rows:
            if at & 0xFFFF == 0:
                want.append((d, o, at, c, None))
            elif (g, c) in first:
                want.append((d, o, at, (at >> 16) + 100, None))
            else:
                first[(g, c)] = (d, o, at)
        for (g, c), (d, o, at) in first.items():
            if sum(x[0] == g for x in first) > 1:
                want.append((d, o, at, (at >> 16) + 100, g))
        assert sorted(whole, key=repr) == sorted(want, key=repr)


def test_blocks_do_not_depend_on_their_size():
    r = random.Random(3)
    base = "".join(r.choice("abcd") for _ in range(400)).encode()
    rows = []
    for doc in range(40):
        for k in range(3):
            a = r.randint(0, 360)
            rows.append((r.choice([1, 1, 1, 2, 3]), doc, k * 200 << 16 | 40, base[a:a + 40]))
    rows.sort(key=lambda x: (x[0], x[1], x[2]))
    frame = pd.DataFrame([(g, d, 0, at, b) for g, d, at, b in rows], columns=["gram", "doc", "ord", "at", "bytes"])

    def covered(block):
        out = pd.concat(list(s.sort_blocks(16, block)([frame.iloc[:50], frame.iloc[50:]])))
        cuts = {(d, i) for d, at, e, key in zip(out.doc, out["at"], out.end, out.key.isna()) if key for i in range(s.start_of(at), e)}
        first = {}
        for d, at, e, key, gram in sorted(zip(out.doc, out["at"], out.end, out.key, out.gram), key=lambda x: (x[0], x[1])):
            if key is not pd.NA and not pd.isna(key):
                if (gram, key) in first:
                    cuts |= {(d, i) for i in range(s.start_of(at), e)}
                first.setdefault((gram, key), (d, at))
        return cuts, out.key.notna().any()
    one, spans = covered(1 << 20)
    small, small_spans = covered(300)
    assert not spans and small_spans
    # Windows of different grams never meet in the operator; here they may, but only within a block.
    by_gram = {g: covered_of(frame[frame.gram == g]) for g in (1, 2, 3)}
    assert set().union(*by_gram.values()) <= one and set().union(*by_gram.values()) <= small


def covered_of(frame):
    first, out = set(), set()
    for _, doc, _, at, b in sorted(frame.itertuples(index=False, name=None), key=lambda x: (x[1], x[3])):
        for i in range(len(b) - 15):
            if b[i:i + 16] in first:
                out |= {(doc, s.start_of(at) + i + k) for k in range(16)}
            first.add(b[i:i + 16])
    return out
