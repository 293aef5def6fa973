"""Cleaning C01-C03: missing values, gap fills (W01/W02), trading-day filter
(P03) and per-store outlier fences (A06).

Scale: per-store windows partition by Store and order by Date; a store's
partition holds at most one row per calendar day, so no window group grows
with the number of stores or with data volume. Fences are exact per-store
percentiles (bounded groups, partial aggregation before the shuffle) joined
back on Store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcast.functions.stats import column_medians, with_scalars
from shopcast.session import materialize

# Fixed values of the cleaning rules.
NO_COMPETITION_DISTANCE = 200_000.0
MIN_TRAINABLE_SALES = 1
WEATHER_PREFIXES = ("Max_", "Mean_", "Min_", "Precipitation", "CloudCover")
TREND_COLUMNS = ("TrendState", "TrendDE")
# One day in so many is looked at first for keys without a value (``unfilled``).
FIRST_LOOK = 32
OUTLIER_STRATEGIES = ("flag", "cap", "remove")


def gap_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(WEATHER_PREFIXES) or c in TREND_COLUMNS]


def fill_forward_back(df: DataFrame, cols: list[str], key: str = "Store", order: str = "Date",
                      scope: str = "store", medians: dict | None = None) -> DataFrame:                   # W01/W02
    """Forward fill then backward fill each column inside ``key`` by ``order``,
    then fill what is still empty with the column median, or with the one that
    ``medians`` gives (columns without one stay empty).

    ``scope="frame"`` reproduces a backward fill that is not grouped: a key
    with no value at all borrows the first value of the next key (in key
    order) that has one. It is computed on a one-row-per-key table, never
    with a window over the whole fact.
    """
    if not cols:
        return df
    if scope not in ("store", "frame"):
        raise ValueError(f"scope must be 'store' or 'frame', got {scope!r}")
    # After the forward fill only leading gaps remain, and the backward fill
    # of a leading gap is the key's first non-null value: a whole-partition
    # frame (linear) instead of an unbounded-following frame (quadratic).
    fwd = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding,
                                                               Window.unboundedFollowing)
    out = df.select(
        *[c for c in df.columns if c not in cols],
        *[F.coalesce(F.last(c, True).over(fwd), F.first(c, True).over(whole)).alias(c)
          for c in cols])
    if scope == "frame":
        firsts = out.groupBy(key).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))
                                        .alias(f"_first_{c}") for c in cols])
        borrow = next_non_null(firsts, key, [f"_first_{c}" for c in cols], [f"_next_{c}" for c in cols])
        out = out.join(borrow, key, "left").select(
            *[c for c in out.columns if c not in cols],
            *[F.coalesce(F.col(c), F.col(f"_next_{c}")).alias(c) for c in cols])
    if medians is None:
        # Only columns that still have gaps need a median. The fill stays a
        # plan, so columns that nobody reads cost no window.
        medians = column_medians(out, unfilled(df, cols, key, order, scope))
    return out.select(*[F.coalesce(F.col(c), F.lit(medians[c])).alias(c) if medians.get(c) is not None
                        else F.col(c) for c in df.columns])


def unfilled(df: DataFrame, cols: list[str], key: str, order: str, scope: str) -> list[str]:
    """The columns that ``fill_forward_back`` leaves with gaps: a key without
    any value keeps them, in scope ``frame`` unless a later key lends it one.
    One aggregate per key, without windows. A key that has a value in some of
    its rows has one, so the rows of a few days come first, and where they show
    a value of every column for every key, the others need not be looked up."""
    few = df.filter(F.pmod(F.xxhash64(order), F.lit(FIRST_LOOK)) == 0).groupBy(key).agg(*[F.count(c).alias(c) for c in cols])
    shown = few.filter(F.least(*[F.col(c) for c in cols], F.lit(1)) > 0)
    if shown.count() == df.select(key).distinct().count():
        return []
    has = df.groupBy(key).agg(F.max(F.col(order).isNotNull()).alias("_lends"), *[F.max(F.col(c).isNotNull()).alias(c) for c in cols])
    if scope == "frame":
        last = has.agg(*[F.max(F.when(F.col(c) & F.col("_lends"), F.col(key))).alias(f"_last_{c}") for c in cols])
        has = with_scalars(has, last).select(*[(F.col(c) | F.coalesce(F.col(key) < F.col(f"_last_{c}"), F.lit(False))).alias(c)
                                               for c in cols])
    left = has.agg(*[F.count(F.when(~F.col(c), F.lit(1))).alias(c) for c in cols]).first()
    return [c for c in cols if left[c]]


def next_non_null(df: DataFrame, key: str, cols: list[str], outs: list[str],
                  num_partitions: int | None = None) -> DataFrame:
    """For each ``key``: the first non-null value of each column among the
    rows with a larger key (a suffix scan), without a global window.

    Keys are range-partitioned; inside a partition a descending running
    ``last(ignorenulls)`` gives the in-partition answer, and the first
    non-null value of every later partition comes from a table with one row
    per partition (broadcast, size = number of partitions). Both read one
    written table of rows with their partition number, because a second
    evaluation of the range exchange may cut the keys elsewhere.
    """
    r = df.repartitionByRange(num_partitions, key) if num_partitions else df.repartitionByRange(key)
    r = materialize(r.withColumn("_pid", F.spark_partition_id()), "keyed")
    inner = Window.partitionBy("_pid").orderBy(F.desc(key)).rowsBetween(Window.unboundedPreceding, -1)
    local = r.select("_pid", key, *[F.last(c, True).over(inner).alias(f"_in_{c}") for c in cols])
    heads = r.groupBy("_pid").agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(key)))
                                    .alias(f"_head_{c}") for c in cols])
    later = Window.orderBy(F.desc("_pid")).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carry = heads.select("_pid", *[F.last(f"_head_{c}", True).over(later).alias(f"_carry_{c}") for c in cols])
    return (local.join(F.broadcast(carry), "_pid", "left")
            .select(key, *[F.coalesce(F.col(f"_in_{c}"), F.col(f"_carry_{c}")).alias(o)
                           for c, o in zip(cols, outs)]))


def clean_missing(df: DataFrame, scope: str = "store", medians: dict | None = None) -> DataFrame:          # C01
    """Impute the known-missing columns. Idempotent: HasCompetition keeps an
    existing value instead of being recomputed from the filled distance.
    ``medians``: as for ``fill_forward_back``."""
    cols = df.columns
    exprs = {}
    if "Open" in cols:
        exprs["Open"] = F.coalesce(F.col("Open"), F.lit(1)).cast("int")
    if "CompetitionDistance" in cols:
        has = (F.coalesce(F.col("HasCompetition"), F.col("CompetitionDistance").isNotNull().cast("int"))
               if "HasCompetition" in cols else F.col("CompetitionDistance").isNotNull().cast("int"))
        exprs["HasCompetition"] = has.cast("int")
        exprs["CompetitionDistance"] = F.coalesce(F.col("CompetitionDistance"),
                                                  F.lit(NO_COMPETITION_DISTANCE))
    for c in ("CompetitionOpenSinceMonth", "CompetitionOpenSinceYear",
              "Promo2SinceWeek", "Promo2SinceYear"):
        if c in cols:
            exprs[c] = F.coalesce(F.col(c).cast("int"), F.lit(0))
    if "PromoInterval" in cols:
        exprs["PromoInterval"] = F.coalesce(F.col("PromoInterval"), F.lit("None"))
    if "StateHoliday" in cols:
        exprs["StateHoliday"] = F.coalesce(F.col("StateHoliday").cast("string"), F.lit("0"))
    out_cols = [exprs.pop(c).alias(c) if c in exprs else F.col(c) for c in cols]
    out_cols += [e.alias(c) for c, e in exprs.items()]  # new columns (HasCompetition)
    out = df.select(*out_cols)
    gaps = gap_columns(out)
    if gaps and "Store" in cols and "Date" in cols:
        out = fill_forward_back(out, gaps, scope=scope, medians=medians)
    return out


def trading_days(df: DataFrame) -> DataFrame:                                 # P03
    """Keep genuinely trading rows: Open = 1 and Sales >= 1."""
    return df.filter((F.col("Open") == 1) & (F.col("Sales") >= MIN_TRAINABLE_SALES))


def outlier_fences(df: DataFrame, iqr_multiplier: float = 3.0, column: str = "Sales") -> DataFrame:  # A06
    """Per-store Tukey fence on open rows: (Store, q1, q3, lower, upper)."""
    rows = df.filter(F.col("Open") == 1) if "Open" in df.columns else df
    q = rows.groupBy("Store").agg(F.percentile(F.col(column), F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    q1, q3 = F.col("q")[0], F.col("q")[1]
    iqr = q3 - q1
    return q.select("Store", q1.alias("q1"), q3.alias("q3"),
                    F.greatest(q1 - iqr_multiplier * iqr, F.lit(0.0)).alias("lower"),
                    (q3 + iqr_multiplier * iqr).alias("upper"))


def handle_outliers(df: DataFrame, strategy: str = "flag", iqr_multiplier: float = 3.0,
                    fences: DataFrame | None = None) -> DataFrame:             # C02
    """Add IsSalesOutlier (open rows outside the store fence); ``cap``
    clips Sales to the fence, ``remove`` drops the flagged rows."""
    if strategy not in OUTLIER_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if fences is None:
        fences = outlier_fences(df, iqr_multiplier)
    is_open = (F.col("Open") == 1) if "Open" in df.columns else F.lit(True)
    flag = F.coalesce(is_open & ((F.col("Sales") < F.col("lower")) | (F.col("Sales") > F.col("upper"))),
                      F.lit(False))
    j = df.join(fences.select("Store", "lower", "upper"), "Store", "left")
    j = j.withColumn("IsSalesOutlier", flag.cast("int"))
    if strategy == "cap":
        capped = F.least(F.greatest(F.col("Sales").cast("double"), F.col("lower")), F.col("upper"))
        j = j.withColumn("Sales", F.when(F.col("IsSalesOutlier") == 1, capped)
                         .otherwise(F.col("Sales").cast("double")))
    elif strategy == "remove":
        j = j.filter(F.col("IsSalesOutlier") == 0)
    return j.drop("lower", "upper")


def clean_dataset(df: DataFrame, outlier_strategy: str = "flag", for_training: bool = True,
                  scope: str = "store") -> DataFrame:                          # C03
    """C01, then (training only) P03 and C02."""
    out = clean_missing(df, scope=scope)
    if for_training and "Sales" in out.columns:
        out = trading_days(out)
        # One row per store, written: passes over the result do not fit again.
        out = handle_outliers(out, strategy=outlier_strategy, fences=materialize(outlier_fences(out), "fences"))
    return out
