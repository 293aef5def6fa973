"""Byte-level BPE (6) and token counts (9) against the installed libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import tiktoken
from brute import sha
from llm_cases import SF_SMALL, docs, nothing, wide  # noqa: F401
from tokenizers import Tokenizer

import __spark_entry__ as entry
from shopcast.llm import byte_bpe, token_counts


def reference_bpe():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def reference_counts(texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def odd_texts():
    r = random.Random(4)
    chars = [chr(c) for c in [*range(1, 0x180), *range(0x390, 0x3D0), 0x130, 0x301, 0x308, 0x85, 0xA0, 0x1C, 0x1F, 0x200B,
                              0x2028, 0x3000, 0x4E2D, 0x1F600]]
    made = ["".join(r.choice(chars) for _ in range(r.randint(0, 50))) for _ in range(800)]
    return made + ["", " ", "x" * 5000, "ab" * 2000 + "é", "<|endoftext|> a <|startoftext|>", "ΟΔΟΣ Σ", "I'LL don't 12 3"]


def test_encoder_equals_library_and_round_trips():
    ref, own = reference_bpe(), byte_bpe.load(byte_bpe.vocabulary("byte_bpe_multi_50k.tiktoken"), byte_bpe.pattern())
    texts = odd_texts()
    for t, ids in zip(texts, own.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == ref.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_counter_equals_library():
    own = token_counts.load(byte_bpe.vocabulary("word_bpe_49k.json"))
    texts = odd_texts()
    assert own.count_batch(texts) == reference_counts(texts)


def test_memory_of_pre_tokens_is_bounded(monkeypatch):
    own = token_counts.WordBpe(byte_bpe.vocabulary("word_bpe_49k.json"))
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 50)
    for i in range(20):
        own.count_batch([f"word{i} other{i} third{i} more{i}"])
        assert len(own.known) <= 70


def test_query_6_equals_library(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    ref, want = reference_bpe(), set()
    for r in rows:
        ids = ref.encode_ordinary(r["text"] or "")
        want.add((r["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(r["text"] or "")))
    assert {tuple(r) for r in entry.queries()["op6_byte_bpe"](spark, SF_SMALL).collect()} == want


def test_query_9_equals_library(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    texts = [r["text"] or "" for r in rows]
    want = {(r["doc_id"], len(t.encode()), n, n > 2048) for r, t, n in zip(rows, texts, reference_counts(texts))}
    assert {tuple(r) for r in entry.queries()["op9_token_counts"](spark, SF_SMALL).collect()} == want


def test_defined_results(docs, wide, nothing):
    got = sorted(map(tuple, byte_bpe.encode_digest(wide).collect()), key=repr)
    assert got == sorted(map(tuple, byte_bpe.encode_digest(docs).collect()), key=repr) and len(got) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert (4, 0, empty, empty) in got and (5, 0, empty, empty) in got and (None, 0, empty, empty) in got
    counted = {(r.doc_id, r.n_tokens) for r in token_counts.count_tokens(wide).collect()}
    assert {(4, 0), (5, 0), (6, 0), (None, 0)} <= counted
    assert [r for r in byte_bpe.encode(docs).collect() if r.doc_id == 8][0].decoded == b"one two three"
    for df in (byte_bpe.encode_digest(nothing), byte_bpe.encode(nothing), token_counts.count_tokens(nothing)):
        assert df.collect() == []
