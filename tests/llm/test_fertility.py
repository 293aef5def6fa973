"""Quality rules (5) against plain counting and the library."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
import tiktoken
from brute import WORD, quality
from llm_cases import SF_SMALL, docs, nothing, unchanged, wide  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shopcast.llm import fertility as f


MODEL, BPE = (public_tokenizers.path(v) for v in f.VOCABULARIES)


def test_base_counts_equal_plain_counting():
    r, p = random.Random(2), f.Words(MODEL)
    for i in range(1500):
        text = "".join(r.choice(["a", "b", "c", " ", "  ", "\n", "\t", "\x0b", "\x85", "#", "|", "é", "\x1c"]) for _ in range(r.randint(0, 80)))
        words, _ = p.numbers([text.encode()])
        assert (len(words), *f.base_counts(text, words)) == quality(text)[:5], repr(text)


def test_measures_equal_the_libraries():
    piece = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    bpe = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=f.read_ranks(BPE), special_tokens={})
    texts = ["Les mots sont là, 漢字 \U0001F600 and so on so on", "", " \t\n ", "one", "a\u00a0b | " + "x" * 3000 + " <|endoftext|> Les mots"]
    w = f.Words(MODEL, BPE)
    numbers, of = w.numbers([t.encode() for t in texts])
    chars = np.array([sum(len(x) for x in re.findall(WORD, t)) for t in texts], float)
    for p, encode, is_byte in ((w.pieces[0], piece.encode, piece.IsByte), (w.pieces[1], bpe.encode_ordinary, lambda i: bool(w.pieces[1].is_byte[i]))):
        for i, (n, per, share, entropy, bits) in enumerate(zip(*p.measures(numbers, of, chars))):
            ids = [k for x in re.findall(WORD, texts[i]) for k in encode(x)]
            assert n == len(ids)
            if ids:
                h = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
                assert math.isclose(per, chars[i] / n) and math.isclose(share, sum(map(is_byte, ids)) / n) and math.isclose(bits, h, abs_tol=1e-12)
                assert math.isclose(entropy, h / math.log2(n) if n > 1 else 0.0, abs_tol=1e-12)
            else:
                assert (per, share, entropy, bits) == (0, 0, 0, 0)


def test_forgotten_words_and_many_words_do_not_change_counts(monkeypatch):
    w = f.Words(MODEL, BPE)
    words, _ = w.numbers([b"a b c " * 5])
    assert f.base_counts("x", words + (1 << 21))[3] == 15
    before = [c.tolist() for p in w.pieces for c in p.measures(words, np.zeros(15, np.int64), np.array([15.0]))]
    monkeypatch.setattr(f, "KNOWN_WORDS", 2)
    other, of = w.numbers([b"new c c", b"b"])
    assert sorted(w.known.values()) == [0, 1, 2] and of.tolist() == [0, 0, 0, 1] and len(w.pieces[1].start) == 4
    words, _ = w.numbers([b"a b c " * 5])
    assert [c.tolist() for p in w.pieces for c in p.measures(words, np.zeros(15, np.int64), np.array([15.0]))] == before


def test_scripts():
    assert [f.script(t) for t in ("word é", "слово", "λόγος", "漢字", "12 !", "")] == ["latin", "cyrillic", "greek", "han", "other", "other"]


def test_query_base_columns_and_clean_documents(spark):
    rows = {r["doc_id"]: r for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF_SMALL}/labels.parquet").to_pylist()}
    got = entry.queries()["op5_fertility"](spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        q = quality(rows[r.doc_id]["text"])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == q
        assert not (r.base_failed and r.kept)
    clean = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert clean and sum(not r.kept for r in clean) <= 0.01 * len(clean)


def test_bands_reject_what_leaves_them():
    band, good = f.BANDS["en"], f.Measures(120, 2.2, 0.0, 0.7, 2.2, 6.0)
    assert f.in_band(band, good)
    for change in ({"chars": 1.2}, {"byte_share": 0.5}, {"entropy": 0.1}, {"chars_2": 1.5}, {"bits": 5.4}):
        assert not f.in_band(band, good._replace(**change))
    assert f.in_band(f.BANDS["other"], good._replace(bits=1.0)) and not f.in_band(band, good._replace(words=2000))
    assert [f.least_bits(n) for n in (0, 49, 50, 99, 1000, 10**6)] == [0.0, 0.0, 5.25, 5.40, 6.08, 6.08]


def test_labelled_junk_goes_and_clean_texts_stay(spark):
    """Labelled texts of sf0.1 that pass the base rule."""
    root = SF_SMALL.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{root}/labels.parquet").select("doc_id", "quality")
    rows = f.judge(spark.read.parquet(f"{root}/documents.parquet").join(labels, "doc_id", "left_semi")).join(labels, "doc_id")
    got = {(r.band, r.quality): (r.all, r.kept) for r in rows.where("not base_failed").groupBy("band", "quality").agg(
        F.count("*").alias("all"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    for lang in ("en", "de", "es", "fr"):
        assert got[(lang, 1)][1] >= 0.99 * got[(lang, 1)][0] and got[(lang, 0)][1] <= 0.1 * got[(lang, 0)][0], got


def test_defined_results(docs, wide, nothing):
    got = {(r.doc_id, r.n_words): r for r in f.judge(wide).collect()}
    assert f.judge(docs).count() == docs.count()
    assert got[(4, 0)].base_failed and not got[(5, 0)].kept and got[(6, 0)].word_chars == 0
    assert got[(13, 210)].base_failed and got[(13, 210)].n_dup_lines == 29
    kept = f.accepted(wide)
    assert kept.columns == wide.columns and unchanged(kept)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in f.judge(docs).collect() if r.kept)
    assert f.judge(nothing).collect() == [] and f.accepted(nothing).collect() == []
    assert f.judge(docs.drop("lang")).count() == docs.count()
