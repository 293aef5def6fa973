"""Collocations against counting everything, and the guarantee of the summaries."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import docs, nothing, wide  # noqa: F401

from shopcast.llm import collocations as co

FOLD = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=10, longest=3, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in cand.items():
            if any(len(h) > len(g) and 100 * b >= 50 * a and any(h[i:i + len(g)] == g for i in range(len(h))) for h, b in cand.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (count[g[:k]] * count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def answer(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def test_edge_documents(docs, wide, nothing):
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    want = brute(rows)
    assert want and answer(co.find_collocations(docs)) == want == answer(co.find_collocations(wide))
    assert answer(co.find_collocations(nothing)) == []
    assert answer(co.find_collocations(docs.drop("lang"))) == brute([(None, t) for _, t in rows])


@pytest.mark.parametrize("chunk, mass", [(4 << 20, 1 << 21), (300, 500)])
def test_all_counts(spark, monkeypatch, chunk, mass):
    monkeypatch.setattr(co, "CHUNK", chunk)
    monkeypatch.setattr(co, "PARTITION_MASS", mass)
    rng = np.random.default_rng(3)
    vocabulary = [f"{'Wü'[i % 2]}{i}" for i in range(60)] + ["a-b", "x'y", " "]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?"]
    rows = [(["en", "de", None, ""][int(rng.integers(4))], "".join(vocabulary[int(x) % 63] + ends[int(y)] for x, y in zip(rng.zipf(1.4, 80), rng.integers(0, 9, 80))))
            for _ in range(150)] + [("en", "the very same words again and again. " * 40)] * 5
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    want = brute(rows, top=30)
    assert len({r[0] for r in want}) == 4 and answer(co.find_collocations(df, top=30)) == want
    monkeypatch.setattr(co, "bit_table", lambda keys: None)
    assert answer(co.find_collocations(df, top=30)) == want


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(7)
    for least in (1, 2, 3, 10, 25):
        keys = np.concatenate([rng.integers(0, 4000, 6000), np.repeat(np.arange(5000, 5040), least)])
        rng.shuffle(keys)
        s = co.Summary(co.capacity(len(keys), least))
        for part in np.array_split(keys, 30):
            k, n = np.unique(part, return_counts=True)
            s.add([k.astype(np.uint64)], [n])
        true = Counter(keys.tolist())
        held = dict(zip(s.keys.tolist(), s.counts.tolist()))
        assert s.taken * (s.capacity + 1) <= len(keys) and s.taken < max(least, 2) and len(held) <= s.capacity
        assert all(true[k] - s.taken <= held.get(k, 0) <= true[k] for k in true)
        assert all(k in held and held[k] + s.taken >= least for k, n in true.items() if n >= least > s.taken)


def test_messages_come_back():
    rng = np.random.default_rng(2)
    for size, top in ((1, 1 << 32), (500, 200), (500, 1 << 20), (500, 1 << 32)):
        keys = np.unique(rng.integers(0, top, size, dtype=np.uint64))
        assert (co.unpacked(*co.packed(keys)) == keys).all()


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000
    rows = [("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 1)]
    out = co.scored(spark.createDataFrame(rows, "lang string, words long, phrase string, f long")).collect()
    assert [(r["l"], r["r"], int(r["score"])) for r in out] == [(big, big + 7, 10**6 * (big - 1) ** 2 // (big * (big + 7)))]
