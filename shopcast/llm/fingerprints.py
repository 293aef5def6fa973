"""Document fingerprints (operator 7), DataFrame functions only.

Method: one-permutation MinHash. Every five-word shingle (lower case; fewer
words: the whole sequence) is hashed once; the upper bits choose one of
``BINS`` bins, the least hash of a bin is its value. Empty bins are filled by
densification: round by round an empty bin looks at the bin that a hash of
(bin, round) names and takes what that one holds by then. The low
``LOW_BITS`` bits of each bin (the hash shifted by the bin's place) are packed into longs; two fingerprints compare
by XOR and bit counts, corrected for the chance match of so few bits.

Sorting the hashes together with one sentinel per bin (the largest hash the
bin can hold) makes the least value of every bin, empty ones included, the
first of its run, so no bin is searched for.

Defined results: a null text is empty; a text without words has the empty
fingerprint (``''``), likeness 1 to another empty one and 0 to any other;
equal texts have equal fingerprints; an empty table gives an empty result.
The next document is the one after (doc_id, text), ids ascending, null ids
first, after the last the first; a lone row is its own next. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.llm.common import shared, text_rows

BINS, LOW_BITS, SHINGLE = 256, 4, 5
PER_LONG = 64 // LOW_BITS
SHIFT = 64 - (BINS.bit_length() - 1)
TOP = (1 << SHIFT) - 1
ROUNDS = 12
#: Documents per block of the search for the next document, blocks per second-level block.
BLOCK, SUPER = 2048, 1024


def empty_bin(v: Column) -> Column:
    return v.bitwiseAND(F.lit(TOP)) == F.lit(TOP)


def probe(bin_: int, round_: int) -> int:
    """The bin that an empty bin looks at in a round: a fixed mixing hash."""
    x = (bin_ * 0x9E3779B97F4A7C15 + round_ * 0xC2B2AE3D27D4EB4F + 1) % (1 << 64)
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * mul) % (1 << 64)
    return ((x ^ (x >> 31)) >> 20) % BINS


def fill_from(bins: Column, look: Column):
    return lambda x, i: F.when(empty_bin(x), F.get(bins, F.get(look, i))).otherwise(x)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: packed fingerprint (array of longs; empty without words).
    Each step is a column of its own, so it is evaluated once."""
    c = {n: f"_{out}_{n}" for n in ("w", "s", "d", "e")}
    words = F.filter(F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    df = df.withColumn(c["w"], F.transform(words, lambda x: F.xxhash64(x)))
    w = F.col(c["w"])
    full = F.transform(F.slice(w, 1, F.size(w) - (SHINGLE - 1)),
                       lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, SHINGLE)]))
    one = F.transform(F.slice(w, 1, 1), lambda x: F.xxhash64(w))
    df = df.withColumn(c["s"], F.when(F.size(w) >= SHINGLE, full).otherwise(one))
    # Hashes sort as signed numbers, and so do the bins (upper bits) and their sentinels.
    half = BINS // 2
    sentinels = F.expr(f"array({', '.join(f'{(b << SHIFT) + TOP}L' for b in range(-half, half))})")
    df = df.withColumn(c["s"], F.sort_array(F.concat(F.col(c["s"]), sentinels)))
    s = F.col(c["s"])
    least = F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, SHIFT) != F.shiftright(F.get(s, i - 1), SHIFT)))
    df = df.withColumn(c["d"], least).drop(c["s"])
    df = df.withColumn(c["e"], F.size(F.filter(F.col(c["d"]), empty_bin)))
    has = F.size(w) > 0
    for r in range(ROUNDS):
        d, todo = F.col(c["d"]), has & (F.col(c["e"]) > 0)
        fill = F.transform(d, fill_from(d, F.expr(f"array({', '.join(str(probe(b, r)) for b in range(BINS))})")))
        df = df.withColumn(c["d"], F.when(todo, fill).otherwise(d))
        df = df.withColumn(c["e"], F.when(todo, F.size(F.filter(F.col(c["d"]), empty_bin))).otherwise(F.lit(0)))
    # Bins that hold one hash must not share its low bits, so each takes them from its own place in the hash.
    df = df.withColumn(c["d"], F.transform(F.col(c["d"]), lambda v, i: F.call_function("shiftright", v, i % (SHIFT - LOW_BITS))))
    d = F.col(c["d"])
    low = (1 << LOW_BITS) - 1
    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), lambda g: F.aggregate(
        F.slice(d, g * PER_LONG + 1, PER_LONG), F.lit(0).cast("long"),
        lambda acc, v: F.shiftleft(acc, LOW_BITS).bitwiseOR(v.bitwiseAND(F.lit(low)))))
    return df.withColumn(out, F.when(has, packed).otherwise(F.array().cast("array<bigint>"))).drop(*c.values())


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints."""
    ones = sum(1 << (LOW_BITS * i) for i in range(PER_LONG))
    ones -= (1 << 64) if ones >> 63 else 0

    def unlike(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for step in (1, 2):
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))
    differ = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda acc, n: acc + n)
    chance = 2.0 ** -LOW_BITS
    est = ((1 - differ / float(BINS)) - chance) / (1 - chance)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), est))))


def with_next(rows: DataFrame, derive: Callable[[DataFrame, str, str], DataFrame] | None = None) -> DataFrame:
    """Add ``next_text`` of the next row by (doc_id, text), and, with
    ``derive(df, text column, new column)``, ``fp`` of each row and ``next_fp``.
    Rows meet in blocks of neighbouring ids (about ``BLOCK`` rows); a block's
    last row gets the first row of the next block that has rows."""
    carry = ["text", "fp"] if derive else ["text"]
    r = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    width = max(1, ((r[1] - r[0] + 1) * BLOCK) // r[2]) if r[2] else 1
    block = F.coalesce(F.floor((F.col("doc_id") - F.lit(r[0] or 0)) / F.lit(width)), F.lit(-1)).cast("long")
    rows = rows.withColumn("_block", block)
    firsts = shared(rows.groupBy("_block").agg(F.min("doc_id").alias("_id")), "next-blocks")
    up = firsts.withColumn("_super", F.floor(F.col("_block") / SUPER))
    tops = up.groupBy("_super").agg(F.min("_block").alias("_first"))
    order = Window.orderBy("_super")
    tops = tops.select("_super", F.coalesce(F.lead("_first").over(order), F.min("_first").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_after"))
    follow = up.join(tops, "_super").select("_id", F.col("_block").alias("_head"), F.coalesce(F.lead("_block").over(
        Window.partitionBy("_super").orderBy("_block")), "_after").alias("_follow"))
    # What each block's first row carries, under the block before it.
    heads = rows.join(follow.select(F.col("_id"), "_head"), (F.col("_block") == F.col("_head")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    heads = heads.groupBy("_head").agg(F.min("text").alias("_text"))
    before = follow.select("_head", "_follow").alias("a").join(heads.alias("b"), F.col("a._follow") == F.col("b._head")).select(
        F.col("a._head").alias("_block"), F.col("b._text").alias("_head_text"))
    if derive:
        before, rows = derive(before, "_head_text", "_head_fp"), derive(rows, "text", "fp")
    w = Window.partitionBy("_block").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    lead = rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carry], F.lead(F.lit(1)).over(w).alias("_has"))
    joined = lead.join(before, "_block", "left")
    for c in carry:
        joined = joined.withColumn(f"next_{c}", F.when(F.col("_has") == 1, F.col(f"next_{c}")).otherwise(F.col(f"_head_{c}")))
    return joined.drop("_has", "_block", *[f"_head_{c}" for c in carry])


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint string) of every row."""
    rows = with_fingerprint(text_rows(docs, id_col, text_col), "text", "fp")
    return rows.select("doc_id", as_text(F.col("fp")).alias("fingerprint"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text (last quarter replaced by
    the start of the next document), and their likeness."""
    rows = with_next(text_rows(docs, id_col, text_col), with_fingerprint).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - cut),
                      F.col("next_text").substr(F.lit(1), cut))
    rows = rows.withColumn("edited", edited).drop("text", "next_text")
    rows = with_fingerprint(rows, "edited", "efp")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                       as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("efp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
