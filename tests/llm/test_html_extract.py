"""HTML extraction (10): parsing, gradients, held-out accuracy."""

import html
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_cases import SF_SMALL  # noqa: F401

import __spark_entry__ as entry
from shopcast.llm import html_extract as h


def texts(page):
    return [b.text for b in h.blocks(page)]


def test_blocks_of_lenient_markup():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>x";</script></head>
    <body><nav><ul><li>One<li>Two</ul></nav><!-- <p>no</p> --><article><h1>Head</h1><p><b>Bold
      text.<br><p>A&nbsp;B &lt;c&gt; <a href="x>y">link</a></p>loose<div>in <i>line</i>d</div></article><template><p>t</p></template>
    <footer>&copy; end"""
    assert texts(page) == ["T & t", "One", "Two", "Head", "Bold text.", "A B <c> link", "loose", "in lined", "© end"]
    assert [h.label_by_markup(b) for b in h.blocks(page)] == [0, 0, 0, 1, 1, 1, 1, 1, 0]
    assert texts("") == [] and texts("plain words") == ["plain words"] and texts("<p>open <b") == ["open"]
    assert texts("</div></p>x</article><p>y") == ["x", "y"] and texts("<script>never closed <p>x") == []


def test_path_names_and_siblings():
    b = h.blocks('<div id="mainNav" class=\'Side-bar x\'><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></div>')
    assert [x.path for x in b][:2] == [("div", "mainnav", "side", "bar", "x", "ul", "li")] * 2
    assert [x.path[-2:] for x in b][2:] == [("tr", "td")] * 3


def test_gradients_equal_differences():
    pages = [h.blocks(f"<body><nav>{i} menu</nav><article><p>some words here {i}</p><p>more</p></article>" + "<p>x</p>" * i) for i in range(3)]
    batch, model, r = h.Batch(pages), h.Labeller(3), np.random.default_rng(0)
    y = np.zeros(batch.shape)
    y[batch.row, batch.col] = [h.label_by_markup(b) for p in pages for b in p]
    _, g = model.gradient(batch, y)
    for k, v in model.p.items():
        at = (int(batch.path[0]), 1) if k == "path" else (int(batch.word[0]), 1) if k == "word" else tuple(r.integers(0, n) for n in v.shape)
        keep, e, loss = v[at], 1e-5, []
        for step in (e, -e):
            v[at] = keep + step
            loss.append(model.gradient(batch, y)[0])
        v[at] = keep
        assert (loss[0] - loss[1]) / (2 * e) == pytest.approx(g[k][at], rel=1e-3, abs=1e-7), k


def test_held_out_pages_and_layouts():
    pages = [r["html"] for r in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()]
    model = h.Labeller()
    losses = model.fit(*h.training_set(pages[:120]))
    assert losses[-1] < 0.05 * losses[0]
    held = pages[120:]
    want = ["\n".join(b.text for b in h.blocks(p) if h.label_by_markup(b)) for p in held]
    got = h.main_text(model, held)
    assert sum(a != b for a, b in zip(got, want)) <= 0.01 * len(held)
    xs, ys = h.training_set(held[:60], seed=99)
    wrong = sum(int((p != np.array(y)).sum()) for p, y in zip(model.predict(xs[60:]), ys[60:]))
    assert wrong <= 0.02 * sum(map(len, ys[60:]))


def test_query_reads_every_page(spark):
    rows = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in entry.queries()["op10_html_extract"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    same = 0
    for r in rows:
        g = got[r["page_id"]]
        assert g.url == r["url"] and g.n_chars == len(g.text)
        same += g.text == "\n".join(b.text for b in h.blocks(r["html"]) if h.label_by_markup(b))
    assert same >= 0.99 * len(rows)


def plain_article(page):
    """The article by plain patterns, without the package's parser: block tags
    part blocks, other tags vanish."""
    m = re.search(r"<article\b[^>]*>(.*?)(?:</article>|<footer|</body>|$)", page, re.S)
    body = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", m.group(1) if m else "", flags=re.S)
    out = []
    for part in re.split(r"</?(?:p|h[1-6]|div|ul|ol|li|table|tr|t[dh]|section|blockquote|pre|figure|article|header|nav|main)\b[^>]*>", body):
        part = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", part)))
        out.append(re.sub(r"\s+", " ", part).strip())
    return "\n".join(filter(None, out))


def test_query_equals_plain_extraction(spark):
    rows = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = {r.page_id: r.text for r in entry.queries()["op10_html_extract"](spark, SF_SMALL).collect()}
    wrong = [r["page_id"] for r in rows if got[r["page_id"]] != plain_article(r["html"])]
    assert len(wrong) <= 0.01 * len(rows), wrong


def test_defined_results(spark):
    page = "<html><body><nav>menu</nav><article><h1>T</h1><p>" + "words and more. " * 30 + "</p></article></body></html>"
    rows = [(1, "u", page, 0), (1, "u", page, 0), (2, None, None, 0), (None, "n", "", 0), (3, "s", "<script>x</script>", 0),
            (4, "long", "<article>" + "<p>a few words.</p>" * 5000 + "</article>", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(map(tuple, h.extract(df).collect()), key=repr)
    assert len(got) == 6 and got[0] == got[1]
    assert {(r[0], r[2], r[3]) for r in got if r[0] not in (1, 4)} == {(2, "", 0), (None, "", 0), (3, "", 0)}
    assert h.extract(df.limit(0)).collect() == []


def test_words_of_short_blocks_are_hashed_together(monkeypatch):
    calls, spans = [], h.word_spans
    monkeypatch.setattr(h, "word_spans", lambda b: calls.append(len(b)) or spans(b))
    short = [f"Block {i} of É words, some ALIKE" for i in range(5_000)] + ["one", "x" * (2 * h.HASHED), "a b"]
    h.Batch([[h.Block(t, ("p",), 0, "p") for t in short]])
    assert len(calls) <= sum(len(t.encode()) + 1 for t in short) // (h.HASHED // 2) + 1 and max(calls) <= 2 * h.HASHED
    ids, sizes = h.word_ids(short)
    alone = [(h.mix(spans(t.encode().lower())[0] + h.U(11)) % h.U(h.WORD_SIZE)).tolist() for t in short]
    assert ids.tolist() == [x for a in alone for x in a] and sizes.tolist() == [len(a) for a in alone]
    assert h.word_ids([])[0].tolist() == [] and h.Batch([[], []]).counts.shape == (0, h.COUNTS)
