"""Personal data (3) against regular expressions."""

import random

import pyarrow.parquet as pq
from brute import luhn, pii as base, sha
from llm_cases import SF_SMALL, docs, nothing, unchanged, wide  # noqa: F401

import __spark_entry__ as entry
from shopcast.llm import pii


def test_base_kinds_equal_regular_expressions_on_noise():
    r = random.Random(9)
    for i in range(20_000):
        alphabet = ("0123456789.+-@ ()ab_%/:x", "0123456789.+- @a", "01.@a-+", "123456789 -")[i % 4]
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        found = pii.spans(text)
        assert {k: found[k] for k in pii.BASE} == base(text), text


def test_query_equals_regular_expressions(spark):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: r for r in entry.queries()["op3_pii"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        b, g = base(r["text"]), got[r["doc_id"]]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(len(b[k]) for k in pii.BASE)
        listed = ",".join(f"{k}:{s}:{e}" for k in pii.BASE for s, e in b[k])
        assert g.base_sha256 == sha(listed) and g.spans.startswith(listed)


def test_added_kinds():
    text = 'see https://a.example.com/x?y=1. IBAN: DE89 3704 0044 0532 0130 00, passport no. 12345678; token = "abc123def4567"'
    found = {k: [text[a:b] for a, b in v] for k, v in pii.spans(text).items()}
    assert found["url"] == ["https://a.example.com/x?y=1"] and found["secret"] == ["abc123def4567"]
    assert found["account"] == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert luhn("4417744280351547") and pii.spans("7536784127813050 4845168114407329")["account"]
    assert not any(pii.spans("an ordinary sentence, accounted for in 1999: tokens and keys.").values())


def test_masked_text_keeps_the_rest():
    assert pii.masked("x a.b@c.org y +1 (017) 555-7713 z") == "x [EMAIL] y [PHONE] z"
    assert pii.masked("") == "" and pii.masked("plain") == "plain"


def test_defined_results(docs, wide, nothing):
    found = pii.find(wide).collect()
    assert len(found) == docs.count() and {r.doc_id for r in found if r.spans} == {7}
    assert all(r.base_sha256 == sha("") for r in found if r.doc_id != 7)
    out = pii.redact(wide, length_col="n_chars")
    assert out.columns == wide.columns and unchanged(out) and out.schema["n_chars"].dataType.typeName() == "long"
    rows = out.collect()
    assert sum(r.text is None for r in rows) == 2
    seven = [r for r in rows if r.doc_id == 7][0]
    assert "[EMAIL] or [PHONE], ip [IP]" in seven.text and seven.n_chars == len(seven.text)
    assert pii.find(nothing).collect() == [] and pii.redact(nothing).collect() == []
