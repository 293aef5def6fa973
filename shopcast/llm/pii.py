"""Personal data by anchor expansion (operator 3).

Method: one Aho-Corasick pass over a text finds anchors (at-signs, digit
cues, schemes, words that announce identifiers). At each anchor a
deterministic local parser expands to the left and right, fixes the boundary
and validates what it found (number parts, Luhn, mod 97, digit counts).

Base kinds, leftmost and non-overlapping per kind: ``email``, ``ip``,
``card``, ``phone``. Added kinds: ``url`` (scheme, authority with a dot),
``account`` (IBAN by check digits; numbers that follow an account or identity
cue), ``secret`` (values assigned to a token, key or password cue).

Offsets are code points, ends exclusive. Defined results: a null text is empty
and has no spans (``redact`` keeps it null); an empty table gives an empty
result; equal rows give equal results; texts are never cut; other columns are
ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.llm.common import map_rows, map_texts, nothing, text_rows, with_column

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("url", "account", "secret")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
CARD_GROUP = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL = re.compile(r"://(?:[A-Za-z0-9._~%!$&'()*+,;=:-]+@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
                 r"(?::[0-9]{1,5})?(?:[/?#][A-Za-z0-9._~:/?#@!$&'()*+,;=%-]*)?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
GAP = r"(?:\x20?(?:no\.?|nr\.?|num(?:ber|éro|ero|mer)?|code))?\x20{0,2}[:#=]?\x20{0,2}[\"']?"
NUMBER = re.compile(GAP + r"([A-Z]{0,3}[0-9](?:[\x20-]?[0-9]){4,})(?![A-Za-z0-9])", re.I)
VALUE = re.compile(r"[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?([A-Za-z0-9_+/.=-]{8,})")

#: Cues in lower case; they also count capitalised and in upper case.
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "passport", "reisepass",
                "passeport", "pasaporte", "ssn", "social security", "routing", "tax id")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey", "access_key", "private_key")


@lru_cache(maxsize=1)
def automaton():
    """Needles with (anchor kind, length)."""
    import ahocorasick
    a = ahocorasick.Automaton()
    needles: dict[str, set[str]] = {"@": {"email"}, "://": {"url"}}
    for d in "0123456789":
        needles.setdefault(d + ".", set()).add("ip")
        needles.setdefault("+" + d, set()).add("phone")
        for e in "0123456789":
            for gap in ("", " ", "-"):
                needles.setdefault(d + gap + e, set()).add("card")
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            for form in (cue, cue.capitalize(), cue.upper()):
                needles.setdefault(form, set()).add(kind)
    for needle, kinds in needles.items():
        a.add_word(needle, (tuple(sorted(kinds)), len(needle)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


# Each parser takes (text, anchor start, anchor end, end of the last match) and
# returns (start, end, valid) of the match it expands to, or None.

def expand_email(text, at, end, last):
    start = at
    while start > last and text[start - 1] in LOCAL:
        start -= 1
    m = DOMAIN.match(text, at) if start < at else None
    return m and (start, m.end(), True)


def expand_ip(text, at, end, last):
    start = at
    while start > last and text[start - 1] in DIGITS:
        start -= 1
    m = IP.match(text, start)
    if m is None:
        return None
    parts = [p.lstrip("0") for p in m.group().split(".")]
    return start, m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def expand_card(text, at, end, last):
    m = CARD.match(text, at)
    digits = [c for c in m.group() if c in DIGITS]
    return at, m.end(), 16 <= len(digits) <= 19 and luhn("".join(digits))


def expand_phone(text, at, end, last):
    m = PHONE.match(text, at)
    return m and (at, m.end(), 8 <= sum(c in DIGITS for c in m.group()) <= 15)


def expand_url(text, at, end, last):
    start = at
    while start > last and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "+-"):
        start -= 1
    while start < at and not text[start].isalpha():
        start += 1
    m = URL.match(text, at) if start < at else None
    return m and (start, at + len(m.group().rstrip(".,;:!?')")), True)


def alone(text, at):
    """Whether a cue that starts here starts a word."""
    return at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "_")


def expand_account(text, at, end, last):
    if not alone(text, at):
        return None
    gap = re.match(GAP, text[end:end + 24], re.I).end()
    m = IBAN.match(text, end + gap)
    if m:
        code = m.group().replace(" ", "")
        for n in range(len(code), 14, -1):
            if mod97(code[:n]):
                stop, seen = m.start(), 0
                while seen < n:
                    seen += text[stop] != " "
                    stop += 1
                return m.start(), stop, True
    m = NUMBER.match(text, end)
    return m and (m.start(1), m.end(1), sum(c in DIGITS for c in m.group(1)) <= 34)


def expand_secret(text, at, end, last):
    m = VALUE.match(text, end)
    if m is None:
        return None
    value = m.group(1)
    return m.start(1), m.end(1), any(c in DIGITS for c in value) and any(c.isalpha() for c in value)


EXPAND = {"email": expand_email, "ip": expand_ip, "card": expand_card, "phone": expand_phone,
          "url": expand_url, "account": expand_account, "secret": expand_secret}


def spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Valid spans of every kind, by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    last = dict.fromkeys(KINDS, 0)
    for stop, (kinds, size) in automaton().iter(text):
        at = stop + 1 - size
        for kind in kinds:
            if at < last[kind]:
                continue
            hit = EXPAND[kind](text, at, stop + 1, last[kind])
            if hit:
                start, end, valid = hit
                last[kind] = max(end, last[kind])
                if valid:
                    found[kind].append((start, end))
                elif kind == "card":
                    found["account"] += [m.span() for m in CARD_GROUP.finditer(text, start, end) if luhn(m.group())]
    found["account"] = apart(found["account"])
    return found


def apart(items: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans by start, without those that overlap an earlier one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(items):
        if not out or out[-1][1] <= a:
            out.append((a, b))
    return out


def listed(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def masked(text: str) -> str:
    """The text with each span replaced by its kind; overlapping spans merge
    under the kind of the leftmost (longest, then first listed)."""
    found = spans(text)
    every = sorted((a, -b, i) for i, k in enumerate(KINDS) for a, b in found[k])
    if not every:
        return text
    out, at, stop, kind = [], 0, -1, 0
    for a, b, i in every:
        if a >= stop:
            if stop >= 0:
                out.append(f"[{KINDS[kind].upper()}]")
                at = stop
            out.append(text[at:a])
            kind, stop = i, -b
        else:
            stop = max(stop, -b)
    return "".join(out) + f"[{KINDS[kind].upper()}]" + text[stop:]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per kind, all spans as ``kind:start:end``,
    digest of the base spans."""
    def make():
        def one(keys, texts):
            found = [spans(t) for t in texts]
            out = {"doc_id": keys}
            out |= {f"n_{k}": [len(f[k]) for f in found] for k in KINDS}
            out["base_sha256"] = [hashlib.sha256(listed(f, BASE).encode()).hexdigest() for f in found]
            out["spans"] = [listed(f, KINDS) for f in found]
            return out
        return one, nothing
    return map_texts(text_rows(docs, id_col, text_col), make,
                     "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows and columns, personal data in the text replaced by its kind;
    ``length_col`` names a column that holds the text's code points."""
    def make():
        def one(batch):
            texts = batch.column(text_col).to_pylist()
            return with_column(batch, text_col, [t if t is None else masked(t) for t in texts])
        return one, nothing
    out = map_rows(docs.withColumn(text_col, F.col(text_col).cast("string")), make)
    if length_col:
        length = F.length(text_col).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(length))
    return out
