"""Statistics helpers (A12-A18, W07, B01-B02) as column expressions and
small DataFrame operators.

Everything stays JVM-side: tail probabilities use a closed-form erfc
approximation evaluated as a column expression on one-row results, ranks
use windows over (value, count) tables instead of the raw rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.session import materialize

#: Terms of the error function's series (below the switch) and of its continued fraction.
ERFC_SWITCH, ERFC_TERMS = 2.0, 200


def erfc(x: Column) -> Column:
    """Complementary error function to double precision: 1 - series below the
    switch, continued fraction from it on. For one-row results."""
    z = F.abs(x)
    zero = F.lit(0.0)
    # erf(z) = 2/sqrt(pi) exp(-z^2) sum over n of 2^n z^(2n+1) / (1 3 5 .. 2n+1), all terms positive
    start = F.struct(z.alias("term"), z.alias("sum"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(ERFC_TERMS)), start, lambda acc, n: F.struct(
        (acc["term"] * 2 * z * z / (2 * n + 1)).alias("term"),
        (acc["sum"] + acc["term"] * 2 * z * z / (2 * n + 1)).alias("sum")), lambda acc: acc["sum"])
    # sqrt(pi) exp(z^2) erfc(z) = 1 / (z + (1/2) / (z + (2/2) / (z + (3/2) / ...)))
    fraction = F.aggregate(F.sequence(F.lit(ERFC_TERMS), F.lit(1), F.lit(-1)), zero, lambda acc, n: n / 2.0 / (z + acc))
    scale = F.exp(-z * z) / math.sqrt(math.pi)
    upper = F.when(z < ERFC_SWITCH, 1 - 2 * scale * series).otherwise(scale / (z + fraction))
    return F.when(x.isNull(), F.lit(None)).when(x >= 0, upper).otherwise(F.lit(2.0) - upper)


def chi2_yates_2x2(a: Column, b: Column, c: Column, d: Column) -> tuple[Column, Column]:
    """Yates-corrected chi-square of [[a, b], [c, d]] and its df=1 p-value."""
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    n = a + b + c + d
    num = n * F.pow(F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0)), 2)
    chi2 = F.try_divide(num, (a + b) * (c + d) * (a + c) * (b + d))
    return chi2, erfc(F.sqrt(chi2 / 2))


def corrected_skewness(x: Column) -> Column:
    """Bias-corrected sample skewness (G1) from Spark's population value."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.try_divide(F.skewness(x) * F.sqrt(n * (n - 1)), n - 2))


def rank_table(vc: DataFrame, value: str, by: list[str] | None = None,
               num_partitions: int | None = None, weight: str = "_c") -> DataFrame:
    """Average ranks on a (by..., value, weight) table with one row per
    (group, value); adds ``_rank`` (ties share the mean of their positions)
    and ``_n`` (rows in the group). Extra columns are kept.

    Rows are range-partitioned on (by..., value), so a large group spans
    many partitions instead of landing in one task. Each partition computes
    running counts of its own rows; a table with one row per (group,
    partition) supplies the count of the group's rows in earlier partitions
    and the group total.

    The range bounds come from a sample, so two evaluations may cut the rows
    differently. The rows are therefore written with their partition number
    once, and totals and ranks both read that table, whatever the planner
    does with repeated exchanges.
    """
    by = list(by or [])
    cols = [*by, value]
    r = vc.repartitionByRange(num_partitions, *cols) if num_partitions else vc.repartitionByRange(*cols)
    r = materialize(r.withColumn("_pid", F.spark_partition_id()), "ranked")
    totals = r.groupBy(*by, "_pid").agg(F.sum(weight).alias("_t"))
    group = Window.partitionBy(*by)
    offsets = totals.select(
        *by, "_pid",
        F.coalesce(F.sum("_t").over(group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_t").over(group).alias("_n"))
    # without groups the offsets have one row per partition: bounded, broadcast
    offsets = offsets if by else F.broadcast(offsets)
    within = Window.partitionBy("_pid", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = r.withColumn("_b", F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return (ranked.join(offsets, by + ["_pid"])
            .withColumn("_rank", F.col("_b") + F.col("_off") + (F.col(weight) + 1) / 2.0)
            .drop("_b", "_off", "_pid"))


def row_index(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number the rows from 0 in ``order`` (which should be unique) without a
    global window: rows are range-partitioned and written with their partition
    number once, each partition numbers its own rows, and a table with one row
    per partition gives the number of rows before it."""
    r = materialize(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), "indexed")
    sizes = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = sizes.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_pid").orderBy(*order)
    return (r.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.row_number().over(within) - 1).drop("_pid", "_off"))


def average_rank(df: DataFrame, value: str, out: str, by: list[str] | None = None,
                 num_partitions: int | None = None) -> DataFrame:          # W07
    """Add the average rank of ``value`` within ``by`` (or over the whole
    frame) to every row. Ranks are computed on the (value, count) table
    (``rank_table``) and joined back on the value; a value shared by many
    rows is a skewed join key, which AQE's skew-join splitting handles."""
    by = list(by or [])
    vc = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    ranks = rank_table(vc, value, by, num_partitions).select(*by, value, F.col("_rank").alias(out))
    return df.join(ranks, by + [value], "left")


def spearman(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Spearman correlation = Pearson correlation of average ranks, over
    rows where both values are present (pairwise complete).

    Rows are first collapsed to distinct (x, y) pairs with a count, so
    repeated values (the skewed ones) become one weighted row before any
    join. Ranks are centred exactly (the mean of average ranks over n rows
    is (n+1)/2), so the weighted sums need no cancelling subtraction.
    """
    by = list(by or [])
    pairs = (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
             .groupBy(*by, x, y).agg(F.count(F.lit(1)).alias("_w")))

    def centred(v: str, out: str) -> DataFrame:
        vc = pairs.groupBy(*by, v).agg(F.sum("_w").alias("_c"))
        return rank_table(vc, v, by).select(*by, v, (F.col("_rank") - (F.col("_n") + 1) / 2.0).alias(out))

    p = pairs.join(centred(x, "_ax"), by + [x]).join(centred(y, "_ay"), by + [y])
    w, ax, ay = F.col("_w"), F.col("_ax"), F.col("_ay")
    g = p.groupBy(*by).agg(F.sum(w * ax * ay).alias("_sxy"), F.sum(w * ax * ax).alias("_sxx"),
                           F.sum(w * ay * ay).alias("_syy"), F.sum(w).alias("n"))
    rho = F.try_divide(F.col("_sxy"), F.sqrt(F.col("_sxx") * F.col("_syy")))
    return g.select(*by, rho.alias("spearman"), "n")


def exact_quantiles(df: DataFrame, value: str, probs: list[float], names: list[str],
                    by: list[str] | None = None, count_col: str | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (position (n-1)q, as
    pandas/numpy, DuckDB ``quantile_cont`` and Spark ``percentile``), one row
    per group, without gathering a group's values in one task.

    Built on ``rank_table``: every distinct value knows the range of sorted
    positions it occupies, so each requested position is answered by the one
    row whose range contains it; only those rows (at most two per quantile and
    group) reach the final aggregate.
    """
    by = list(by or [])
    vc = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    first = F.col("_rank") - (F.col("_c") - 1) / 2.0
    rt = rank_table(vc, value, by, num_partitions).select(
        *by, F.col(value).cast("double").alias("_v"), first.alias("_s"),
        (first + F.col("_c") - 1).alias("_e"), "_n")

    def covers(pos):
        return (F.col("_s") <= pos) & (pos <= F.col("_e"))

    keep, aggs = F.lit(False), []
    for q, name in zip(probs, names):
        h = (F.col("_n") - 1) * F.lit(float(q))
        lo, hi = F.floor(h) + 1, F.ceil(h) + 1
        keep = keep | covers(lo) | covers(hi)
        v_lo = F.max(F.when(covers(lo), F.col("_v")))
        v_hi = F.max(F.when(covers(hi), F.col("_v")))
        aggs.append((v_lo + F.max(h - F.floor(h)) * (v_hi - v_lo)).alias(name))
    if count_col:
        aggs.append(F.max("_n").cast("bigint").alias(count_col))
    return rt.filter(keep).groupBy(*by).agg(*aggs)


def column_medians(df: DataFrame, cols: list[str]) -> dict:
    """Exact median of each column in one job (columns stacked as
    (column, value) rows and ranked per column); None for an all-null column."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in cols])).alias("_p"))
    m = exact_quantiles(long.select("_p._col", "_p._x"), "_x", [0.5], ["_m"], by=["_col"])
    got = {r["_col"]: r["_m"] for r in m.collect()}          # one row per column
    return {c: got.get(c) for c in cols}


def lower_medians(df: DataFrame, cols: list[str]) -> dict:
    """The value at sorted position ceil(n / 2) of each column, without nulls
    and NaNs, in one job as ``column_medians``; None for a column without
    values. No task holds a column's values."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_col"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(cols)])).alias("_p"))
    vc = (long.select("_p._col", "_p._x").filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
          .groupBy("_col", "_x").agg(F.count(F.lit(1)).alias("_c")))
    first = F.col("_rank") - (F.col("_c") - 1) / 2.0
    middle = F.ceil(F.col("_n") / 2)
    m = rank_table(vc, "_x", ["_col"]).filter((first <= middle) & (middle < first + F.col("_c")))
    got = {r["_col"]: r["_x"] for r in m.select("_col", "_x").collect()}      # one row per column
    return {c: got.get(i) for i, c in enumerate(cols)}


def qcut_index(x: Column, edges: list[Column]) -> Column:
    """Quantile bin (0-based) with right-closed bins, lowest value included."""
    out = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        out = F.when(x <= edges[i], F.lit(i)).otherwise(out)
    return out


def right_closed_bin(x: Column, edges: list[float], labels: list[str]) -> Column:  # B01
    """Label of the right-closed bin (e_i, e_i+1]; NULL outside (e_0, e_n]."""
    out = F.lit(None).cast("string")
    for lo, hi, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        cond = (x > lo) if math.isinf(hi) else ((x > lo) & (x <= hi))
        out = F.when(cond, F.lit(lab)).otherwise(out)
    return out


def right_closed_ordinal(x: Column, edges: list[float]) -> Column:
    out = F.lit(None).cast("int")
    for i, (lo, hi) in reversed(list(enumerate(zip(edges[:-1], edges[1:])))):
        cond = (x > lo) if math.isinf(hi) else ((x > lo) & (x <= hi))
        out = F.when(cond, F.lit(i)).otherwise(out)
    return out


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row DataFrame to every row.

    An equi-join on a constant key with a broadcast one-row side (size is
    one row by construction), so the plan has no cartesian product.
    """
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one"))


def box_summary(df: DataFrame, x: str, by: list[str]) -> DataFrame:       # A17
    """q1, median, q3, whiskers at 1.5 IQR (most extreme points inside the
    fence) and the number of points outside, per group."""
    q = exact_quantiles(df, x, [0.25, 0.5, 0.75], ["q1", "median", "q3"], by, count_col="n")
    j = df.join(q, by)
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col(x) >= lo) & (F.col(x) <= hi)
    return j.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(x))).alias("whisker_low"),
        F.max(F.when(inside, F.col(x))).alias("whisker_high"),
        F.count(F.when(~inside, F.lit(1))).alias("fliers"))


def mann_whitney(df: DataFrame, x: str, group: str, first: str, second: str) -> DataFrame:  # A15
    """Two-sided Mann-Whitney U of ``x`` between two groups (normal
    approximation with tie and continuity correction). Returns one row:
    u_statistic (of ``first``), p_value, n1, n2."""
    s = df.filter(F.col(group).isin(first, second) & F.col(x).isNotNull())
    # One row per distinct value: all rows, rows of ``first``; the rank sum of
    # ``first`` is sum(count_first * average rank) -- no join back to rows.
    vc = s.groupBy(x).agg(F.count(F.lit(1)).alias("_c"),
                          F.count(F.when(F.col(group) == first, F.lit(1))).alias("_c1"))
    a = rank_table(vc, x).agg(
        F.sum(F.col("_c1") * F.col("_rank")).alias("r1"),
        F.sum("_c1").cast("double").alias("n1"),
        F.sum(F.col("_c") - F.col("_c1")).cast("double").alias("n2"),
        F.sum(F.pow(F.col("_c").cast("double"), 3) - F.col("_c")).alias("tie"))
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    u2 = n1 * n2 - u1
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("tie"), n * (n - 1))))
    z = F.try_divide(F.greatest(u1, u2) - n1 * n2 / 2 - 0.5, sigma)
    # With all values tied there is no spread and no p-value.
    p = F.when(z.isNotNull(), F.least(erfc(z / math.sqrt(2.0)), F.lit(1.0)))
    return a.select(u1.alias("u_statistic"), p.alias("p_value"),
                    n1.cast("bigint").alias("n1"), n2.cast("bigint").alias("n2"))


def histogram(df: DataFrame, x: str, bins: int) -> DataFrame:              # A18
    """Equal-width histogram between min and max (last bin right-closed):
    (bin, lo, hi, count). Empty bins are omitted."""
    mm = df.agg(F.min(x).cast("double").alias("_mn"), F.max(x).cast("double").alias("_mx"))
    j = with_scalars(df.select(x).filter(F.col(x).isNotNull()), mm)
    width = (F.col("_mx") - F.col("_mn")) / bins
    idx = F.least(F.floor(F.try_divide(F.col(x) - F.col("_mn"), F.col("_mx") - F.col("_mn")) * bins),
                  F.lit(bins - 1)).cast("int")
    idx = F.when(F.col("_mx") == F.col("_mn"), F.lit(0)).otherwise(idx)
    return (j.groupBy(idx.alias("bin"), "_mn", "_mx").agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (F.col("_mn") + F.col("bin") * (F.col("_mx") - F.col("_mn")) / bins).alias("lo"),
                    (F.col("_mn") + (F.col("bin") + 1) * (F.col("_mx") - F.col("_mn")) / bins).alias("hi"),
                    "count"))
