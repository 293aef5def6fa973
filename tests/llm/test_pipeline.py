"""The corpus pipeline against plain versions of its stages."""

from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
from brute import mix_targets, near_components, quality, sha, WORD
from llm_cases import SF_SMALL, docs, nothing, wide  # noqa: F401
from test_tokens import reference_bpe

import __spark_entry__ as entry
from shopcast.llm import fertility, mixing, pii


def plain_rules(rows):
    """Rows that pass: base rules by plain counting, bands by the measures."""
    words, out = fertility.tokenizers(None), []
    for r in rows:
        n, chars, *_, failed = quality(r["text"])
        numbers, of = words.numbers([r["text"].encode()])
        (_, per, share, entropy, _), (_, per_2, _, _, bits) = (
            [float(c[0]) for c in p.measures(numbers, of, np.array([float(chars)]))] for p in words.pieces)
        if not failed and fertility.in_band(fertility.BANDS[r["lang"]], fertility.Measures(n, per, share, entropy, per_2, bits)):
            out.append(r)
    return out


def test_run_equals_plain_stages(spark):
    rows = plain_rules(pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist())
    near = near_components([(r["doc_id"], r["text"]) for r in rows])
    rows = [r | {"text": pii.masked(r["text"])} for r in rows if near[r["doc_id"]][1] == r["doc_id"]]
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    target, ref = mix_targets(dict(sizes)), reference_bpe()
    got = entry.queries()["pipeline"](spark, SF_SMALL).collect()
    times, by = Counter(r.doc_id for r in got), {r.doc_id: r for r in got}
    for s in sizes:
        own = [(times[r["doc_id"]], len(WORD.findall(r["text"]))) for r in rows if r["source"] == s]
        assert abs(sum(t * n for t, n in own) - target[s]) <= max(n for _, n in own) and max(t for t, _ in own) <= 2
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert set(by) <= set(texts) and len(by) > 0.5 * len(texts)
    for d, r in by.items():
        assert r.decoded_sha256 == sha(texts[d]) and r.n_tokens == len(ref.encode_ordinary(texts[d]))


def test_stages_keep_columns_and_take_any_rows(spark, wide, nothing):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "mask_personal_data", "mix_sources", "encode_texts"]
    for df in (wide, nothing):
        columns = df.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, SF_SMALL)
            assert df.columns == columns
            df.count()
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF_SMALL).count() == df.count()


def test_mix_stage_repeats_what_the_plan_says(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = {r.doc_id: r.repeats for r in mixing.plan_rows(table).collect()}
    times = Counter(r.doc_id for r in mixing.mix(table).select("doc_id").collect())
    assert {d: n for d, n in plan.items() if n} == dict(times)
