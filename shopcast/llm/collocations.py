"""Phrase collocation mining (operator 12).

Method: Misra-Gries summaries per hash partition. Texts are lower-cased (A-Z),
cut into pieces and words; every run of 1 to ``max_words`` words inside a piece
is an n-gram of its language. Pass 1: tasks send, for each hash partition, the
different 32-bit fingerprints of a chunk of text with their counts (sorted,
differences in as few bytes as they need); a partition merges them in a
Misra-Gries summary of more counters than twice its mass over the threshold.
What it takes off a counter then stays below half the threshold, so every
frequent n-gram survives, and survivors that cannot reach the threshold go.
Pass 2 counts the survivors exactly: tasks keep n-grams that a bit table of the
survivors lets pass (a constant bound in bytes; beyond it all n-grams pass),
and add up their texts, which decides.

Of the counts follow candidates (frequent phrases of two words and more), their
lowest-scoring cut, those that no longer candidate covers, and ranks.

Scale: the number of partitions follows the bytes of the texts, a partition's
mass is bounded by ``PARTITION_MASS`` but for n-grams that occur more often
(one entry a chunk); a task holds chunks of ``CHUNK`` bytes, longer texts are
worked on in several, cut where pieces end, so nothing is lost. The first
``top`` of a language are taken in two steps.

Defined results: a null text is empty; a null or missing language is ``und``;
repeated rows count each time; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcast.llm.common import shared
from shopcast.llm.shingles import STEP, U, mix, word_spans

MIN_COUNT, MAX_WORDS, TOP, COVER = 10, 3, 2000, 50
NO_LANG = "und"
CHUNK = 2 << 20
#: Occurrences of n-grams that a hash partition is meant for.
PARTITION_MASS = 1 << 21
#: The bit table: parts, and bits of a part at most (32 MB in all).
PARTS, PART_BITS = 256, 20
#: Parts of a language's candidates that are ranked before all are.
SALTS = 64

_FOLD = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def fold(text: str) -> bytes:
    """Lower-cased text whose pieces end at newlines and whose words at spaces."""
    return text.encode().translate(_FOLD)


def chunks_of(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[str, bytes]]:
    """(language, folded texts) in chunks of about so many bytes."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            b, at = fold(text), 0
            while at < len(b):
                end = len(b)
                if end - at > chunk:
                    end = b.rfind(b"\n", at, at + chunk) + 1 or b.find(b"\n", at + chunk) + 1 or len(b)
                held.setdefault(lang, []).append(b[at:end])
                size[lang] = size.get(lang, 0) + end - at + 1
                total, at = total + end - at + 1, end
                if total > chunk:
                    most = max(size, key=size.get)
                    yield most, b"\n".join(held.pop(most))
                    total -= size.pop(most)
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


class Grams:
    """The n-grams of a chunk: hashes by number of words, words and places."""

    def __init__(self, lang: str, text: bytes, max_words: int):
        self.text = text
        self.word, self.start, self.end = word_spans(text)
        piece = np.cumsum(np.frombuffer(text, np.uint8) == 10, dtype=np.int32)[self.start]
        seed = U(int.from_bytes(lang.encode()[:8].ljust(8, b"\0"), "little")) + U(hash_of(lang))
        self.hashes, self.at = [], []
        for k in range(1, max_words + 1):
            m = max(len(self.word) - k + 1, 0)
            at = np.flatnonzero(piece[:m] == piece[k - 1:])
            h = np.full(len(at), U(k)) ^ seed
            for i in range(k):
                h += self.word[at + i] * STEP[i]
            self.hashes.append(mix(h))
            self.at.append(at)

    def phrase(self, at: int, k: int) -> str:
        return b" ".join([self.text[self.start[i]:self.end[i]] for i in range(at, at + k)]).decode()


def hash_of(lang: str) -> int:
    h = 1
    for c in lang.encode():
        h = (h * 0x100000001B3 ^ c) & 0xFFFFFFFFFFFFFFFF
    return h


def packed(values: np.ndarray) -> tuple[int, bytes]:
    """Differences of sorted 32-bit numbers, in as few bytes each as the largest needs."""
    gap = np.diff(values, prepend=U(0)).astype("<u4")
    width = max((int(gap.max()).bit_length() + 7) // 8, 1)
    return width, gap.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def unpacked(width: int, data: bytes) -> np.ndarray:
    gap = np.zeros((len(data) // width, 4), np.uint8)
    gap[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return np.cumsum(gap.view("<u4")[:, 0], dtype=U)


MESSAGE = "part long, mass long, width int, gaps binary, at binary, more binary"


def messages(part_bits: int, max_words: int):
    """Pass 1: per chunk and hash partition the different fingerprints and
    their counts (``at``, ``more``: which are above one, and by how many)."""
    chunk = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in chunks_of(batches, chunk):
            keys = np.sort(np.concatenate(Grams(lang, text, max_words).hashes) >> U(32 - part_bits))
            if not len(keys):
                continue
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            count, keys = np.diff(np.append(begin, len(keys))), keys[begin]
            part = (keys >> U(32)).astype(np.int64)
            border = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            out = []
            for i, j in zip(border[:-1], border[1:]):
                n = count[i:j]
                some = np.flatnonzero(n > 1)
                out.append((int(part[i]), int(n.sum()), *packed(keys[i:j] & U(0xFFFFFFFF)), some.astype("<u4").tobytes(),
                            (n[some] - 1).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=[f.split()[0] for f in MESSAGE.split(", ")]), schema=pa.schema(
                [("part", pa.int64()), ("mass", pa.int64()), ("width", pa.int32()), ("gaps", pa.binary()), ("at", pa.binary()), ("more", pa.binary())]),
                preserve_index=False)
    return run


class Summary:
    """Misra-Gries counters of sorted keys; summaries add up."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, U), np.zeros(0, np.int64)

    def add(self, keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        """Merge exact counts; a key's counter falls short by ``taken`` at most,
        and ``taken`` * (capacity + 1) never exceeds the mass added."""
        keys, counts = np.concatenate([self.keys, *keys]), np.concatenate([self.counts, *counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts = keys[begin], np.add.reduceat(counts, begin)
        if len(self.keys) > self.capacity:
            least = np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1]
            left = self.counts > least
            self.keys, self.counts = self.keys[left], self.counts[left] - least
            self.taken += int(least)


def capacity(mass: int, min_count: int) -> int:
    """Counters of a summary: over twice the mass by the threshold."""
    return mass // max(min_count // 2, 1) + 1


def survivors(min_count: int):
    """Merge the messages of one hash partition; keys that may be frequent."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        s = Summary(capacity(int(g["mass"].sum()), min_count))
        keys, counts, held = [], [], 0
        for width, gaps, at, more in zip(g["width"], g["gaps"], g["at"], g["more"]):
            k = unpacked(width, gaps)
            n = np.ones(len(k), np.int64)
            n[np.frombuffer(at, "<u4")] += np.frombuffer(more, "<u4")
            keys.append(k)
            counts.append(n)
            held += len(k)
            if held > s.capacity:
                s.add(keys, counts)
                keys, counts, held = [], [], 0
        if keys:
            s.add(keys, counts)
        left = s.keys[s.counts + s.taken >= min_count]
        return pd.DataFrame({"key": (left | U(int(g["part"].iloc[0]) << 32)).view(np.int64)})
    return run


def spots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each key in its part of the bit table."""
    mask = U((1 << bits) - 1)
    return (keys >> U(8)) & mask, mix(keys) & mask


def bit_table(keys: DataFrame) -> tuple[np.ndarray, int] | None:
    """Table of the surviving keys, 16 bits for each, and the bits of a part;
    none where the keys are too many for one of ``PARTS`` * 2 ** ``PART_BITS`` bits."""
    n = keys.count()
    if n > PARTS << PART_BITS:
        return None
    bits = min(max((16 * n // PARTS).bit_length(), 10), PART_BITS)

    def fill(g: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(1 << bits, bool)
        for at in spots(g["key"].to_numpy().astype(U), bits):
            part[at.astype(np.int64)] = True
        return pd.DataFrame({"part": g["part"].iloc[:1], "bits": [np.packbits(part).tobytes()]})

    table = np.zeros((PARTS, 1 << bits >> 3), np.uint8)
    for r in keys.withColumn("part", F.col("key").bitwiseAND(F.lit(PARTS - 1))).groupBy("part").applyInPandas(fill, "part long, bits binary").collect():
        table[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return table, bits


def counted(table, part_bits: int, max_words: int):
    """Pass 2: per chunk the n-grams that the table lets pass, with counts, and
    (with no words) the number of all words."""
    chunk = CHUNK

    def passes(h: np.ndarray) -> np.ndarray:
        if table.value is None:
            return np.ones(len(h), bool)
        bytes_, bits = table.value
        keys = h >> U(32 - part_bits)
        part = (keys & U(PARTS - 1)).astype(np.int64)
        ok = np.ones(len(keys), bool)
        for at in spots(keys, bits):
            at = at.astype(np.int64)
            ok &= (bytes_[part, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return ok

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in chunks_of(batches, chunk):
            g = Grams(lang, text, max_words)
            words, phrases, counts = [np.zeros(1, np.int64)], [""], [np.array([len(g.word)])]
            for k, (h, at) in enumerate(zip(g.hashes, g.at), 1):
                ok = passes(h)
                _, first, n = np.unique(h[ok], return_index=True, return_counts=True)
                phrases += [g.phrase(i, k) for i in at[ok][first].tolist()]
                words.append(np.full(len(n), k))
                counts.append(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases)), pa.array(np.concatenate(words)), pa.array(phrases, pa.string()),
                                              pa.array(np.concatenate(counts))], ["lang", "words", "phrase", "f"])
    return run


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """(lang, words, phrase, f): the exact counts of all n-grams that occur
    ``min_count`` times or more, and of all words (``words`` 0)."""
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.coalesce(lang, F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A word and its gap take about six bytes.
    mass = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6 * max_words
    part_bits = min((mass // PARTITION_MASS).bit_length(), 24)
    keys = rows.mapInArrow(messages(part_bits, max_words), MESSAGE).groupBy("part").applyInPandas(survivors(min_count), "key long")
    keys = shared(keys, "phrase-survivors")
    table = docs.sparkSession.sparkContext.broadcast(bit_table(keys))
    found = rows.mapInArrow(counted(table, part_bits, max_words), "lang string, words long, phrase string, f long")
    found = found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= min_count) | (F.col("words") == 0))
    return shared(found, "phrase-counts")


def part_of(phrase, start, size):
    return F.array_join(F.slice(F.split(phrase, " "), start, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of the candidates at their
    lowest-scoring cut, the earliest of equal ones."""
    cut, a = F.col("cut"), F.col("a").cast("decimal(15,0)")
    cuts = counts.where("words > 1").withColumnRenamed("f", "a").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1)))
    cuts = cuts.withColumn("left", part_of("phrase", F.lit(1), cut)).withColumn("right", part_of("phrase", cut + 1, F.col("words").cast("int") - cut))
    for side, name in (("left", "l"), ("right", "r")):
        of = counts.where("words > 0").select(F.col("lang"), F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(of, ["lang", side])
    score = F.lit(1_000_000).cast("decimal(7,0)") * a * a
    under = F.col("l").cast("decimal(15,0)") * F.col("r").cast("decimal(15,0)")
    cuts = cuts.withColumn("over", score).withColumn("under", under).withColumn("score", F.expr("over div under"))
    least = cuts.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    return least.select("lang", "words", "phrase", "a", "least.l", "least.r", "least.score")


def uncovered(candidates: DataFrame, cover: int = COVER) -> DataFrame:
    """Candidates without a longer one around their words that is found in
    ``cover`` percent of their occurrences or more."""
    long = candidates.where("words > 2").select("lang", "a", "words", "phrase")
    size = F.explode(F.sequence(F.lit(2), F.col("words").cast("int") - 1))
    inner = long.withColumn("size", size).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - F.col("size") + 1)))
    inner = inner.select("lang", "a", part_of("phrase", F.col("at"), F.col("size")).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    out = candidates.join(inner, ["lang", "phrase"], "left")
    return out.where(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True))).drop("longer")


def find_collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, cover: int = COVER,
                      text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` of each language."""
    counts = phrase_counts(docs, min_count, max_words, text_col, lang_col)
    left = uncovered(shared(scored(counts), "phrase-scored"), cover)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    left = left.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    left = left.withColumn("rank", rank).where(F.col("rank") <= top)
    n = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return left.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
