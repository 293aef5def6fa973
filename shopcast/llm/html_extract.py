"""Main text of HTML pages by a recurrent block labeller (operator 10).

Method: a page becomes its sequence of leaf blocks (text between block-level
tags). Each block gives a tag-path vector (tags, class and id words of all
ancestors, hashed into an embedding), a hashed-word vector and a few counts.
A bidirectional LSTM in numpy reads the whole sequence, so every block is
labelled main or not with the context of all others; main blocks are joined.

The labeller is fitted on the driver from at most ``sample`` pages (those with
the least hash of id and html), which is all that it ever sees of the table. Their
blocks are labelled by markup: inside an article and not inside a menu,
header, footer, sidebar, notice, advert, form or comment list. To learn other
layouts than the sample's, each sampled page is also rebuilt in random layouts
whose labels are known by construction. Scripts, styles, templates and markup
comments never become blocks.

Defined results: null html is empty; a page without main blocks has the empty
text; equal pages give equal texts; an empty table gives an empty result;
unclosed, truncated or stray tags are read leniently; other columns are
ignored. Pages are read whole.
"""

from __future__ import annotations

import html
import random
import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_texts, nothing
from shopcast.llm.shingles import U, mix, word_spans

SAMPLE_PAGES = 192
EPOCHS = 14
PATH_SIZE, WORD_SIZE, PATH_DIM, WORD_DIM, HIDDEN = 2048, 512, 16, 8, 16
COUNTS = 8
#: Bytes of short texts whose words are hashed together.
HASHED = 1 << 16

RAW = "script|style|template|noscript|iframe|svg|textarea|select|object|math"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?:/>|>.*?(?:</\1\s*>|\Z))"
                   r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-z]+", re.I)
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre
section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that close an open element of the same group first.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
#: Elements beyond which an implied end tag does not reach.
SCOPES = frozenset("article aside body div footer form header main nav section table ul ol dl td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

BOILERPLATE = frozenset("""nav header footer aside form menu head title button option legend dialog ad ads advert advertisement
banner promo sponsor sidebar related share social cookie notice consent newsletter subscribe comment comments
reply replies disqus breadcrumb breadcrumbs pagination pager navbar navigation masthead copyright login search widget""".split())
MAIN = frozenset("article main".split())


class Block:
    __slots__ = ("text", "path", "links", "tag")

    def __init__(self, text: str, path: tuple, links: int, tag: str):
        self.text, self.path, self.links, self.tag = text, path, links, tag


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page, in order, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    parts: list[str] = []
    linked, in_link = 0, 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = tuple(x for _, names in stack for x in names)
                out.append(Block(text, path, min(linked, len(text)), next((t for t, _ in reversed(stack) if t in BLOCKS), "")))
            parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text.strip())

    def pop_to(tags, scope) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            add(" ")
        elif tag == "a":
            in_link = not m.group(2)
        if tag not in BLOCKS:
            if tag not in VOID and ("class" in m.group(4) or "id" in m.group(4)):
                if not m.group(2):
                    stack.append((tag, names_of(tag, m.group(4))))
            elif m.group(2):
                pop_to({tag}, SCOPES)
            continue
        close()
        in_link = False
        if m.group(2):
            pop_to({tag}, () if tag in SCOPES else SCOPES)
            continue
        if tag in SIBLINGS:
            pop_to(SIBLINGS[tag], {"ul", "ol", "dl", "table"} if tag != "tr" else {"table"})
        pop_to({"p"} | (HEADINGS if tag in HEADINGS else set()), SCOPES)
        if tag == "body":
            pop_to({"head"}, ())
        if tag not in VOID and not m.group(4).rstrip().endswith("/"):
            stack.append((tag, names_of(tag, m.group(4))))
    if at < len(page):
        add(page[at:])
    close()
    return out


def names_of(tag: str, attributes: str) -> tuple:
    """The tag and the words of its class, id and role."""
    if not attributes or "=" not in attributes:
        return (tag,)
    out = [tag]
    for m in ATTRIBUTE.finditer(attributes):
        out += [x.lower() for x in NAME.findall(m.group(2) or m.group(3) or m.group(4) or "")]
    return tuple(out)


def label_by_markup(b: Block) -> int:
    names = set(b.path)
    return int(bool(names & MAIN) and not names & BOILERPLATE)


# ---- features ---------------------------------------------------------------

def path_ids(path: tuple) -> list[int]:
    """Hashed ids of a path's names, and of its deepest names by place."""
    names = [*path, *(f"{i}:{n}" for i, n in enumerate(reversed(path[-3:])))] or ["-"]
    return [stable_hash(n) % PATH_SIZE for n in names]


def stable_hash(name: str) -> int:
    x = 1469598103934665603
    for c in name.encode():
        x = (x ^ c) * 1099511628211 % (1 << 64)
    return (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64) >> 20


def word_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed ids of the words of texts, one after the other, and how many each
    text has. Short texts are hashed together, up to ``HASHED`` bytes at once."""
    ids, sizes, held, size = [], [], [], 0

    def flush() -> None:
        nonlocal held, size
        h, start, _ = word_spans(b"\n".join(held))
        ids.append((mix(h + U(11)) % U(WORD_SIZE)).astype(np.int64))
        ends = np.cumsum([len(t) + 1 for t in held])
        sizes.append(np.diff(np.searchsorted(start, ends), prepend=0))
        held, size = [], 0

    for text in texts:
        b = text.encode().lower()
        if held and size + len(b) > HASHED:
            flush()
        held.append(b)
        size += len(b) + 1
    if held:
        flush()
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ids]), np.concatenate([none, *sizes])


def counts(blocks: list[Block]) -> np.ndarray:
    """``COUNTS`` numbers per block."""
    n = np.array([len(b.text) for b in blocks], float)
    words = np.array([b.text.count(" ") + 1 for b in blocks], float)
    stops = np.array([sum(map(b.text.count, ".!?;")) for b in blocks], float)
    links = np.array([b.links for b in blocks], float)
    marks = np.array([(b.tag in HEADINGS, b.tag == "li", "©" in b.text or "|" in b.text) for b in blocks], float).reshape(len(blocks), 3)
    return np.column_stack([np.log1p(n) / 8, np.log1p(words) / 6, links / n, stops / words, marks, np.ones(len(blocks))])


class Batch:
    """Pages as padded arrays: ragged path and word ids, counts, mask."""

    def __init__(self, pages: list[list[Block]]):
        self.size = np.array([len(p) for p in pages])
        self.shape = (len(pages), max(1, int(self.size.max())))
        flat = [b for p in pages for b in p]
        self.row = np.repeat(np.arange(len(pages)), self.size)
        self.col = np.concatenate([np.arange(n) for n in self.size]) if flat else np.zeros(0, np.int64)
        self.mask = np.zeros(self.shape)
        self.mask[self.row, self.col] = 1
        memo: dict[tuple, list[int]] = {}
        paths = [memo.get(b.path) or memo.setdefault(b.path, path_ids(b.path)) for b in flat]
        self.path, self.path_of, self.path_w = ragged(np.fromiter(chain.from_iterable(paths), np.int64), [len(p) for p in paths])
        self.word, self.word_of, self.word_w = ragged(*word_ids([b.text for b in flat]))
        self.counts = counts(flat)
        t = np.arange(self.shape[1])
        self.flip = np.where(t < self.size[:, None], self.size[:, None] - 1 - t, t)


def ragged(flat: np.ndarray, sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists one after the other: their values, lists, and weights within."""
    n = np.asarray(sizes, np.int64)
    return flat, np.repeat(np.arange(len(n)), n), np.repeat(1 / np.maximum(n, 1), n)


def gather(table: np.ndarray, ids: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Weighted sums of table rows per block."""
    out = np.zeros((n, table.shape[1]))
    if len(ids):
        start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        out[of[start]] = np.add.reduceat(table[ids] * weight[:, None], start, axis=0)
    return out


# ---- the network ------------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction: x (pages, steps, d) -> hidden states."""

    @staticmethod
    def forward(p: dict, x: np.ndarray, mask: np.ndarray, keep: bool):
        n, steps, _ = x.shape
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        xs = x @ p["x"] + p["b"]
        out, saved = np.zeros((n, steps, HIDDEN)), []
        for t in range(steps):
            z = xs[:, t] + h @ p["h"]
            s = sigmoid(z[:, :3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            m = mask[:, t, None]
            if keep:
                saved.append((h, c, i, f, o, g, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * c2 + (1 - m) * c
            out[:, t] = h
        return out, saved

    @staticmethod
    def backward(p: dict, x: np.ndarray, saved: list, dout: np.ndarray):
        n, steps, _ = x.shape
        dz = np.zeros((n, steps, 4 * HIDDEN))
        dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        gh = np.zeros_like(p["h"])
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, g, tc, m = saved[t]
            dh = dh + dout[:, t]
            dhm, dcm = dh * m, dc * m + dh * m * o * (1 - tc * tc)
            z = np.concatenate([dcm * g * i * (1 - i), dcm * c * f * (1 - f), dhm * tc * o * (1 - o), dcm * i * (1 - g * g)], axis=1)
            dz[:, t] = z
            gh += h.T @ z
            dh, dc = z @ p["h"].T + dh * (1 - m), dcm * f + dc * (1 - m)
        flat = dz.reshape(-1, 4 * HIDDEN)
        return {"x": x.reshape(-1, x.shape[2]).T @ flat, "h": gh, "b": flat.sum(0)}, dz @ p["x"].T


class Labeller:
    """Embeddings, two LSTMs, one logistic output per block."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + COUNTS
        self.p = {"path": r.normal(0, 0.5, (PATH_SIZE, PATH_DIM)), "word": r.normal(0, 0.1, (WORD_SIZE, WORD_DIM)),
                  "out": r.normal(0, 0.2, 2 * HIDDEN + d), "bias": np.zeros(1)}
        for side in ("fore", "back"):
            self.p |= {f"{side}.x": r.normal(0, d ** -0.5, (d, 4 * HIDDEN)),
                       f"{side}.h": r.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN)), f"{side}.b": np.zeros(4 * HIDDEN)}

    def side(self, name: str) -> dict:
        return {k: self.p[f"{name}.{k}"] for k in "xhb"}

    def forward(self, b: Batch, keep: bool = False):
        n = len(b.row)
        x = np.zeros((*b.shape, PATH_DIM + WORD_DIM + COUNTS))
        x[b.row, b.col] = np.concatenate([gather(self.p["path"], b.path, b.path_of, b.path_w, n),
                                          gather(self.p["word"], b.word, b.word_of, b.word_w, n), b.counts], axis=1)
        rows = np.arange(b.shape[0])[:, None]
        fore, s1 = Lstm.forward(self.side("fore"), x, b.mask, keep)
        back, s2 = Lstm.forward(self.side("back"), x[rows, b.flip], b.mask, keep)
        feats = np.concatenate([fore, back[rows, b.flip], x], axis=2)
        return feats @ self.p["out"] + self.p["bias"], (x, feats, s1, s2)

    def predict(self, pages: list[list[Block]]) -> list[np.ndarray]:
        b = Batch(pages)
        z, _ = self.forward(b)
        return [z[i, :n] > 0 for i, n in enumerate(b.size)]

    def gradient(self, b: Batch, y: np.ndarray) -> tuple[float, dict]:
        z, (x, feats, s1, s2) = self.forward(b, keep=True)
        prob = sigmoid(z)
        total = b.mask.sum()
        loss = -float((b.mask * (y * np.log(prob + 1e-12) + (1 - y) * np.log(1 - prob + 1e-12))).sum() / total)
        dz = b.mask * (prob - y) / total
        rows = np.arange(b.shape[0])[:, None]
        g = {"out": np.tensordot(dz, feats, 2), "bias": np.array([dz.sum()])}
        df = dz[..., None] * self.p["out"]
        one, dx1 = Lstm.backward(self.side("fore"), x, s1, df[..., :HIDDEN])
        two, dx2 = Lstm.backward(self.side("back"), x[rows, b.flip], s2, df[..., HIDDEN:2 * HIDDEN][rows, b.flip])
        g |= {f"fore.{k}": v for k, v in one.items()} | {f"back.{k}": v for k, v in two.items()}
        dx = (df[..., 2 * HIDDEN:] + dx1 + dx2[rows, b.flip])[b.row, b.col]
        for name, ids, of, weight, part in (("path", b.path, b.path_of, b.path_w, dx[:, :PATH_DIM]),
                                            ("word", b.word, b.word_of, b.word_w, dx[:, PATH_DIM:PATH_DIM + WORD_DIM])):
            g[name] = np.zeros_like(self.p[name])
            np.add.at(g[name], ids, part[of] * weight[:, None])
        return loss, g

    def fit(self, pages: list[list[Block]], labels: list[list[int]], epochs: int = EPOCHS, size: int = 32, seed: int = 7) -> list[float]:
        """Adam over shuffled batches; returns the loss of each epoch."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        order, step, losses = np.argsort([len(p) for p in pages], kind="stable"), 0, []
        groups = [order[i:i + size] for i in range(0, len(order), size)]
        ready = []
        for group in groups:
            b = Batch([pages[i] for i in group])
            y = np.zeros(b.shape)
            y[b.row, b.col] = np.concatenate([labels[i] for i in group])
            ready.append((b, y))
        for epoch in range(epochs):
            rate, seen = 0.02 if epoch < epochs * 2 // 3 else 0.005, 0.0
            for i in r.permutation(len(ready)):
                loss, g = self.gradient(*ready[i])
                norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                step += 1
                for k, v in g.items():
                    v = v * min(1.0, 5 / (norm + 1e-12))
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.99 * s[k] + 0.01 * v * v
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
                seen += loss / len(ready)
            losses.append(seen)
        return losses


# ---- training pages ---------------------------------------------------------

#: Private-use character that marks main blocks of rebuilt pages.
MARK = "\ue000"
FRAMES = ('<article>{}</article>', '<main>{}</main>', '<main><article class="post">{}</article></main>',
          '<div class="article-body">{}</div>', '<div id="content"><div class="entry-content">{}</div></div>',
          '<section class="story">{}</section>', '<div class="post-content">{}</div>', '<div role="main">{}</div>',
          '<div class="wrapper"><div class="page-content">{}</div></div>', '<td class="content">{}</td>')
ASIDES = ('<aside>{}</aside>', '<div class="sidebar">{}</div>', '<div id="sidebar" class="widget">{}</div>', '<div class="ad">{}</div>',
          '<div class="advert">{}</div>', '<div class="banner promo">{}</div>', '<div class="cookie-notice">{}</div>',
          '<div class="notice">{}</div>', '<div role="alert" class="consent">{}</div>', '<form action="/s">{}<button>Go</button></form>',
          '<div class="newsletter"><form>{}</form></div>', '<section class="comments">{}</section>', '<section id="comments"><h3>Comments</h3>{}</section>',
          '<div class="comment-list"><div class="comment">{}</div></div>', '<ol class="commentlist"><li class="comment">{}</li></ol>',
          '<div class="related">{}</div>', '<div class="share social">{}</div>', '<div class="breadcrumb">{}</div>',
          '<nav class="menu">{}</nav>', '<header class="site-header">{}</header>', '<footer>{}</footer>', '<div class="footer">{}</div>',
          '<div class="header"><div class="logo">{}</div></div>', '<div class="popup subscribe">{}</div>', '<ul class="nav"><li><a href="/">{}</a></li></ul>')
WRAPS = ("<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<li>{}</li>", "<blockquote>{}</blockquote>", "<p><span>{}</span></p>")


def rebuilt(page: list[Block], pool: list[str], r: random.Random) -> tuple[str, set[str]]:
    """The page's main blocks in a random layout amid other blocks whose words
    come from the same pool; marks tell main texts apart."""
    main = [b.text for b in page if label_by_markup(b)] or pool[:2]
    keep = []

    def mark(text: str) -> str:
        keep.append(f"{MARK}{len(keep)} {text}")
        return html.escape(keep[-1], quote=False)

    def other() -> str:
        inner = "".join(r.choice(WRAPS[:5]).format(html.escape(r.choice(pool))) for _ in range(r.randint(1, 3)))
        return r.choice(ASIDES).format(inner)

    body = [f"<h1>{mark(main[0])}</h1>"] if r.random() < 0.7 else []
    wrap = r.choice(WRAPS)
    for text in main[1:] or main:
        body.append((wrap if r.random() < 0.7 else r.choice(WRAPS)).format(mark(text)))
        if r.random() < 0.08:
            body.append(other())
        if r.random() < 0.08:
            body.append(f"<h2>{mark(' '.join(r.choice(pool).split()[:6]))}</h2>")
    if r.random() < 0.2:
        body.append(other())
    before = "".join(other() for _ in range(r.randint(0, 3)))
    after = "".join(other() for _ in range(r.randint(0, 4)))
    frame = r.choice(FRAMES)
    return f"<html><head><title>{html.escape(main[0][:60])}</title></head><body>{before}{frame.format(''.join(body))}{after}</body></html>", set(keep)


def training_set(pages: list[str], seed: int = 7) -> tuple[list[list[Block]], list[list[int]]]:
    r = random.Random(seed)
    parsed = [p for p in map(blocks, pages) if p]
    xs, ys = list(parsed), [[label_by_markup(b) for b in p] for p in parsed]
    pool = [b.text for p in parsed for b in p][:20_000] or ["text"]
    for p in parsed * 2:
        text, _ = rebuilt(p, pool, r)
        x = blocks(text)
        ys.append([int(b.text.startswith(MARK)) for b in x])
        for b in x:
            if b.text.startswith(MARK):
                b.text = b.text.split(" ", 1)[-1]
        xs.append(x)
    return xs, ys


def fit_labeller(pages: DataFrame, sample: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """Labeller fitted on at most ``sample`` pages."""
    page = F.col(html_col).cast("string")
    rows = pages.select(F.xxhash64(F.col(id_col), page).alias("place"), page.alias("html")).where("length(html) > 0")
    # A share of the hashes that holds some four samples: few rows leave each task, however many tasks there are.
    n, span = pages.count(), 1 << 64
    near = rows if n <= 4 * sample else rows.where(F.col("place") < -(span // 2) + span * 4 * sample // n)
    got = [r["html"] for r in near.orderBy("place").limit(sample).collect()]
    model = Labeller()
    xs, ys = training_set(got)
    if xs:
        model.fit(xs, ys)
    return model


def main_text(model: Labeller, pages: list[str]) -> list[str]:
    parsed = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, p in enumerate(parsed) if p), key=lambda i: len(parsed[i]))
    at = 0
    while at < len(order):
        # Pages of similar length together; a batch holds a bounded number of block places.
        n = max(1, min(64, 20_000 // len(parsed[order[min(at + 63, len(order) - 1)]])))
        part = order[at:at + n]
        at += n
        for i, main in zip(part, model.predict([parsed[i] for i in part])):
            out[i] = "\n".join(b.text for b, ok in zip(parsed[i], main) if ok)
    return out


def extract(pages: DataFrame, model: Labeller | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = model or fit_labeller(pages, id_col=id_col, html_col=html_col)
    rows = pages.select(F.struct(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url")).alias("key"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def make():
        def one(keys, texts):
            out = main_text(model, texts)
            return {"page_id": [k["id"] for k in keys], "url": [k["url"] for k in keys], "text": out, "n_chars": [len(t) for t in out]}
        return one, nothing
    return map_texts(rows, make, "page_id long, url string, text string, n_chars long")
