"""Mixing sources to target weights (operator 8), DataFrame functions only.

Method: capped water-filling. Sources share ``share`` times the size of
everything in proportion to their weights; a source stops at ``max_epochs``
times its size and the excess is shared again by weight among the others,
until none is above. A target becomes repetitions: every document whole
``floor(target / source size)`` times, and the fractional rest once more for
the documents that come first in a seeded hash order, up to the point where
their sizes reach the rest.

That point is found without sorting a source: the hash is read 12 bits at a
time, sizes are summed per (source, 12 bits) with map-side partial sums, and
only the interval that holds the point is read further, so a hot source costs
no more than 4,096 sums per level.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, a null or empty text has
size 0; null is a source of its own, after all others; equal rows share their
hash and are taken alike; an empty table gives an empty result; input columns
with other names (also ``size``, ``target``) pass through ``mix`` unchanged
and are ignored by ``plan_rows``. Sources are numbered in one sort of one row
per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.llm.common import WORD, free_names, shared

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 20240229
BITS, LEVELS = 12, 5


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def position(id_col: Column, text: Column, seed: int = SEED) -> Column:
    """Place of a row in the seeded order of its source: 60 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, text), 64 - BITS * LEVELS)


def by_source(rows: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row per source: size and weight."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights))
    return rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", pick)


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target``: the level rises until no source is above its cap; each
    round reads two sums."""
    cap = F.col("source_size") * float(max_epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    if not total:
        return sources.withColumn("target", F.lit(0.0))
    budget, level, capped = min(share, max_epochs) * total, -1.0, -1
    while True:
        above = cap <= F.lit(level) * F.col("weight")
        r = sources.agg(F.sum(F.when(above, cap)).alias("cap"), F.sum(F.when(~above, F.col("weight"))).alias("w"),
                        F.count(F.when(above, 1)).alias("n")).first()
        if r["n"] == capped or not r["w"]:
            break
        capped, level = r["n"], (budget - (r["cap"] or 0.0)) / r["w"]
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def cuts(rows: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
         weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Per source: target, whole repetitions, and the place ``cut`` in the
    hash order before which (``at_cut``: and at which) documents repeat once
    more. ``rows`` has source, size, place."""
    sources = shared(by_source(rows, weights), "mix-sources")
    epochs = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    plan = water_fill(sources, share, max_epochs).withColumn("whole", F.coalesce(F.floor(epochs), F.lit(0)))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # Of a source with a rest: the interval of places that holds its point.
    state = plan.where("rest > 0").select("source", F.lit(0).cast("long").alias("prefix"), "rest",
                                          F.lit(None).cast("long").alias("cut"), F.lit(None).cast("long").alias("there"))
    for level in range(LEVELS):
        state = shared(state, "mix-level")
        if level and not state.where("cut is null").limit(1).count():
            break
        open_, low = state.where("cut is null").drop("cut", "there"), BITS * (LEVELS - level - 1)
        inside = rows.join(open_.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        inside = inside.where(F.shiftright("place", low + BITS) == F.col("prefix"))
        sums = inside.groupBy("source", "rest", F.shiftright("place", low).alias("prefix")).agg(
            F.sum("size").alias("n"), F.min("place").alias("first"), F.max("place").alias("last"))
        run = F.sum("n").over(Window.partitionBy("source").orderBy("prefix"))
        most = F.max("prefix").over(Window.partitionBy("source"))
        # Sizes are whole numbers, so the last interval takes a rest beyond the sum by rounding.
        hit = sums.withColumn("run", run).withColumn("most", most).where(
            (F.col("run") - F.col("n") < F.col("rest")) & ((F.col("run") >= F.col("rest")) | (F.col("prefix") == F.col("most"))))
        single = F.col("first") == F.col("last")
        state = state.where("cut is not null").unionByName(hit.select(
            "source", "prefix", (F.col("rest") - F.col("run") + F.col("n")).alias("rest"),
            F.when(single, F.col("first")).alias("cut"), F.when(single, F.col("n")).alias("there")))
    found = state.select(F.col("source").alias("_source"), F.coalesce("cut", "prefix").alias("cut"),
                         (F.col("rest") * 2 >= F.coalesce("there", F.lit(0))).alias("at_cut"))
    out = plan.join(found, F.col("source").eqNullSafe(F.col("_source")), "left")
    return shared(out.select(F.col("source").alias("_source"), "source_size", "target", "whole",
                             F.coalesce("cut", F.lit(0)).alias("cut"), F.coalesce("at_cut", F.lit(False)).alias("at_cut")),
                  "mix-cuts")


def repeats(place: str) -> Column:
    more = (F.col(place) < F.col("cut")) | ((F.col(place) == F.col("cut")) & F.col("at_cut"))
    return (F.col("whole") + more.cast("long")).cast("long")


def plan_rows(docs: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
              weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """One row per document: its size, its source's size and target, the
    repetitions, the words the mix takes of it."""
    text = F.col("text").cast("string")
    rows = shared(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                              n_words(text).alias("size"), position(F.col("doc_id"), text, seed).alias("place")), "mix-rows")
    joined = rows.join(cuts(rows, share, max_epochs, weights), F.col("source").eqNullSafe(F.col("_source")))
    return joined.select("doc_id", "size", "source_size", "target",
                         (F.col("size") * repeats("place")).alias("taken"), repeats("place").alias("repeats"), "source")


def mix(docs: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it."""
    text = F.col("text").cast("string")
    rows = shared(docs.select(F.col("source").cast("string").alias("source"), n_words(text).alias("size"),
                              position(F.col("doc_id"), text, seed).alias("place")), "mix-rows")
    place, source, whole, cut, at_cut, copy = free_names(docs, "mix_place", "mix_source", "mix_whole", "mix_cut", "mix_at", "mix_copy")
    plan = cuts(rows, share, max_epochs, weights).select(F.col("_source").alias(source), F.col("whole").alias(whole),
                                                         F.col("cut").alias(cut), F.col("at_cut").alias(at_cut))
    more = (F.col(place) < F.col(cut)) | ((F.col(place) == F.col(cut)) & F.col(at_cut))
    joined = docs.withColumn(place, position(F.col("doc_id"), text, seed)).join(
        plan, F.col("source").cast("string").eqNullSafe(F.col(source)))
    times = (F.col(whole) + more.cast("long")).cast("int")
    return joined.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), times)).alias(copy)).select(*docs.columns)
