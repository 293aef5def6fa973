"""Splits and samples: P04 chronological hold-out, P05 store sample,
P06 row sample, P07 membership.

All samples are deterministic functions of a seed and the row keys (a hash
order, not ``rand()``), so a recomputed partition after executor loss
selects exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALIDATION_DAYS = 42
# Multiplier of the store-order hash (Knuth's multiplicative constant) and
# its modulus; expressible in any SQL dialect.
HASH_MULT = 2654435761
HASH_MOD = 4294967296


def split_cutoff(df: DataFrame, days: int = VALIDATION_DAYS) -> DataFrame:
    """One-row frame with the cutoff date max(Date) - days."""
    return df.agg(F.date_sub(F.max("Date"), days).alias("cutoff"))


def chrono_split(df: DataFrame, days: int = VALIDATION_DAYS) -> DataFrame:   # P04
    """Add ``split`` = train (Date <= cutoff) / valid (Date > cutoff)."""
    from shopcast.functions.stats import with_scalars
    j = with_scalars(df, split_cutoff(df, days))
    return j.withColumn("split", F.when(F.col("Date") <= F.col("cutoff"), "train").otherwise("valid")) \
        .drop("cutoff")


def store_order_key(store: Column, seed: int = 42) -> Column:
    return ((store.cast("bigint") + F.lit(seed)) * F.lit(HASH_MULT)) % F.lit(HASH_MOD)


def sample_stores(df: DataFrame, n: int, seed: int = 42) -> DataFrame:       # P05
    """``n`` distinct stores chosen by a seeded hash order (no replacement)."""
    stores = df.select("Store").distinct()
    return stores.orderBy(store_order_key(F.col("Store"), seed), F.col("Store")).limit(n)


def keep_stores(df: DataFrame, stores: DataFrame) -> DataFrame:               # P07
    return df.join(stores.select("Store"), "Store", "left_semi")


def sample_rows(df: DataFrame, fraction: float, seed: int = 42, key: tuple[str, ...] = ("Store", "Date")) -> DataFrame:  # P06
    """Rows whose seeded key hash lies in the lowest ``fraction`` of the hash
    range: independent of partitioning, equal keys stay together."""
    place = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), F.lit(HASH_MOD))
    return df.filter(place < F.lit(int(fraction * HASH_MOD)))
