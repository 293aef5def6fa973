"""Time-series operators K01-K07, W05, W06, W08, W09.

A series is a DataFrame ``(id..., Date, value)``; every operator works on
all series at once, partitioned by the series id. A store series has at
most one row per calendar day, so each window partition and each grouped
pandas call is bounded by the calendar span, never by the store count.

All of it is column expressions: the ADF regression works on one matrix of
cross moments per series (plain sums, so map-side combined), which an array
fold eliminates; the Durbin-Levinson recursion is a fold as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.functions.stats import erfc
from shopcast.session import materialize

WINDOW = 14
VAL_DAYS = 42
MIN_EXTRA = 10


def national_series(df: DataFrame) -> DataFrame:                            # K01
    """Total sales per day over rows with Sales > 0: (Date, value)."""
    return df.filter(F.col("Sales") > 0).groupBy("Date").agg(F.sum("Sales").alias("value"))


def store_series(df: DataFrame) -> DataFrame:                               # K01 (per store)
    """Each store's trading-day series: (Store, Date, value); gaps skipped."""
    return df.filter(F.col("Sales") > 0).select("Store", "Date", F.col("Sales").alias("value"))


def first_difference(s: DataFrame, by: list[str] | None = None, order: str = "Date",
                     value: str = "value") -> DataFrame:                    # W05
    """value - previous value in ``order`` within ``by``; the first row of
    each series is dropped."""
    by = list(by or [])
    w = Window.partitionBy(*by).orderBy(order)
    return (s.withColumn("diff", F.col(value) - F.lag(value).over(w))
            .filter(F.col("diff").isNotNull()))


def acf(s: DataFrame, by: list[str] | None = None, order: str = "Date", value: str = "value",
        nlags: int = 21) -> DataFrame:                                       # K04
    """Biased autocorrelation (denominator n) for lags 0..nlags of each
    series: (by..., lag, acf, n).

    One window pass: every row sees its ``nlags`` predecessors through ``lag``,
    the products are summed per series, so there is no join of the series with
    itself. A constant or one-row series has no autocorrelation (NULL).
    """
    key = list(by or []) or ["_series"]
    if not by:
        s = s.withColumn("_series", F.lit("all"))
    w = Window.partitionBy(*key).orderBy(order)
    whole = Window.partitionBy(*key)
    v = F.col(value).cast("double")
    x = s.select(*key, order, (v - F.avg(v).over(whole)).alias("d"))
    x = x.select(*key, "d", *[F.lag("d", k).over(w).alias(f"_l{k}") for k in range(1, nlags + 1)])
    c = x.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("d") * F.col("d")).alias("_c0"),
                            *[F.sum(F.col("d") * F.col(f"_l{k}")).alias(f"_c{k}") for k in range(1, nlags + 1)])
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_c{k}").alias("c")) for k in range(nlags + 1)])
    # Lags beyond the series' length have no products and no row.
    out = (c.select(*key, F.col("n").cast("bigint").alias("n"), "_c0", F.inline(lags))
           .filter(F.col("lag") < F.col("n"))
           .select(*key, "lag", F.try_divide(F.col("c"), F.col("_c0")).alias("acf"), "n"))
    return out if by else out.drop("_series")


def durbin_levinson(rho: Column) -> Column:
    """Partial autocorrelations of lags 0..K from the array of autocorrelations
    of lags 0..K; NULL from the first lag on that no regression determines."""
    zero = F.lit(0.0)

    def dot(phi: Column, far: Column) -> Column:
        return F.aggregate(F.zip_with(phi, far, lambda x, y: x * y), zero, lambda acc, v: acc + v)

    def fold(state: Column, k: Column) -> Column:
        phi, near = state["phi"], F.slice(rho, F.lit(2), k - 1)            # rho 1..k-1
        last = F.try_divide(F.get(rho, k) - dot(phi, F.reverse(near)), F.lit(1.0) - dot(phi, near))
        # An array of one, so that the coefficient is computed once.
        return F.element_at(F.transform(F.array(last), lambda v: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - v * y), F.array(v)).alias("phi"),
            F.concat(state["out"], F.array(v)).alias("out"))), 1)

    lags = F.filter(F.sequence(F.lit(0), F.size(rho) - 1), lambda k: k > 0)
    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).alias("out"))
    return F.aggregate(lags, start, fold, lambda state: state["out"])


def pacf(acf_df: DataFrame, by: list[str] | None = None) -> DataFrame:      # K05
    """Yule-Walker partial autocorrelation with n-k denominators, from the
    acf table (nlags+1 rows per series). A series without autocorrelation has
    no partial one either (NULL)."""
    key = list(by or []) or ["_series"]
    df = acf_df if by else acf_df.withColumn("_series", F.lit("all"))
    lag = F.col("lag").cast("int")
    g = df.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(lag.alias("lag"), "acf", "n"))).alias("_rows"))
    rho = F.transform("_rows", lambda r: r["acf"] * r["n"] / (r["n"] - r["lag"]))
    found = F.when(F.forall("_rows", lambda r: r["acf"].isNotNull()), durbin_levinson(F.col("_rho")))
    g = g.withColumn("_rho", rho).withColumn("_pacf", found)
    rows = F.zip_with("_rows", F.sequence(F.lit(0), F.size("_rows") - 1), lambda r, i: F.struct(
        r["lag"].alias("lag"), r["acf"].alias("acf"), F.get(F.col("_pacf"), i).alias("pacf")))
    out = g.select(*key, F.inline(rows))
    return out if by else out.drop("_series")


# MacKinnon (1994) response surface for the ADF p-value with a
# constant and one variable (max/min statistic, switch point, small- and
# large-statistic polynomial coefficients), and MacKinnon (2010) critical
# value surfaces (1 %, 5 %, 10 %) in powers of 1/nobs.
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALLP = [2.1659, 1.4412, 0.038269]
ADF_LARGEP = [1.7339, 0.93202, -0.12745, -0.010368]
ADF_CRIT = {"crit_1pct": [-3.43035, -6.5393, -16.786, -79.433],
            "crit_5pct": [-2.86154, -2.8903, -4.234, -40.04],
            "crit_10pct": [-2.56677, -1.5384, -2.809, 0.0]}


#: Pivots and residuals below this share of their column's square sum count as
#: none: the regression is not determined.
ADF_TOLERANCE = 1e-10
ADF_MIN_ROWS = 6


def adf_pvalue(stat: Column) -> Column:
    """MacKinnon's approximate p-value of the statistic."""
    def poly(coef: list[float]) -> Column:
        out = F.lit(coef[-1])
        for c in reversed(coef[:-1]):
            out = out * stat + F.lit(c)
        return out
    z = F.when(stat <= ADF_TAU_STAR, poly(ADF_SMALLP)).otherwise(poly(ADF_LARGEP))
    p = F.lit(0.5) * erfc(-z / math.sqrt(2.0))
    return F.when(stat > ADF_TAU_MAX, 1.0).when(stat < ADF_TAU_MIN, 0.0).when(stat.isNotNull(), p)


def adf_lags(n: Column) -> Column:
    """Most lags that a series of ``n`` values is tried with."""
    most = F.ceil(F.lit(12.0) * F.pow(n / F.lit(100.0), F.lit(0.25))).cast("int")
    return F.greatest(F.least((n / 2).cast("int") - 2, most), F.lit(0))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once (an array of one)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _lagged_moments(x: Column, d: Column, lags: Column) -> Column:
    """Sums over the sample t that ``lags`` leaves, of levels x[t] and lagged
    differences d[t-j] for j = 0..lags: ``rows``, ``x`` (levels), ``xx``
    (squares), ``s`` (differences), ``xd`` (levels by differences) and ``dd``
    (row j: difference j by differences j..lags).

    Moving both lags by one moves the sample by one, so a product sum follows
    from the one before by its first and last term: only the sums of lag 0 go
    over the values. Sums of integers are exact."""
    n, rows = F.size(d), F.size(d) - lags
    steps = F.filter(F.sequence(F.lit(0), lags), lambda j: j > 0)
    ends = lambda values, j, k: values(lags - j) * F.get(d, lags - j - k) - values(n - j) * F.get(d, n - j - k)

    def all_sums(z: Column) -> Column:
        dd = F.aggregate(steps, F.array(z["dd"]), lambda acc, j: F.concat(acc, F.array(F.transform(
            F.slice(F.element_at(acc, -1), F.lit(1), lags + 1 - j), lambda v, q: v + ends(lambda at: F.get(d, at), j, q)))))
        return _once(dd, lambda h: F.struct(
            rows.cast("double").alias("rows"), z["x"].alias("x"), z["xx"].alias("xx"), h.alias("dd"),
            F.transform(F.sequence(F.lit(0), lags), lambda j: F.get(x, n - j) - F.get(x, lags - j)).alias("s"),
            F.aggregate(steps, F.array(z["xd"]), lambda acc, j: F.concat(acc, F.array(
                F.element_at(acc, -1) + F.get(F.get(h, F.lit(1)), j - 1)
                + F.get(x, lags - 1) * F.get(d, lags - j) - F.get(x, n - 1) * F.get(d, n - j)))).alias("xd")))

    own = F.struct(F.slice(x, lags + 1, rows).alias("x"), F.slice(d, lags + 1, rows).alias("d"))
    return _once(own, lambda t: _once(F.struct(
        F.aggregate(t["x"], F.lit(0.0), lambda acc, v: acc + v).alias("x"), _dot(t["x"], t["x"]).alias("xx"), _dot(t["x"], t["d"]).alias("xd"),
        F.transform(F.sequence(F.lit(0), lags), lambda j: _dot(t["d"], F.slice(d, lags + 1 - j, rows))).alias("dd")), all_sums))


def _half_moments(x: Column, d: Column, lags: Column, level_last: bool = False) -> Column:
    """Upper half of the symmetric matrix of cross moments (row i from its
    diagonal on) over the sample that ``lags`` leaves, of the columns: 1, the
    last level, the lagged differences, the target; ``level_last`` puts the
    level right before the target."""
    def rest(values: Column) -> Column:
        return F.slice(values, F.lit(2), F.size(values) - 1)

    def matrix(z: Column) -> Column:
        one, level, now = F.array(z["rows"]), F.array(z["x"]), F.get(z["dd"], F.lit(0))
        s0, xd0, target = F.slice(z["s"], 1, 1), F.slice(z["xd"], 1, 1), F.array(F.slice(now, 1, 1))
        if level_last:
            lagged = F.transform(rest(z["dd"]), lambda row, i: F.concat(row, F.array(F.get(z["xd"], i + 1), F.get(now, i + 1))))
            return F.concat(F.array(F.concat(one, rest(z["s"]), level, s0)), lagged, F.array(F.concat(F.array(z["xx"]), xd0)), target)
        lagged = F.transform(rest(z["dd"]), lambda row, i: F.concat(row, F.array(F.get(now, i + 1))))
        return F.concat(F.array(F.concat(one, level, rest(z["s"]), s0), F.concat(F.array(z["xx"]), rest(z["xd"]), xd0)), lagged, target)
    return _once(_lagged_moments(x, d, lags), matrix)


def _cross_moments(x: Column, d: Column, lags: Column) -> Column:
    """The whole matrix of ``_half_moments``, flat."""
    return _once(_half_moments(x, d, lags), lambda h: F.flatten(F.transform(h, lambda _, i: F.transform(
        h, lambda _, j: F.get(F.get(h, F.least(i, j)), F.abs(i - j))))))


def _eliminated(half: Column, steps: Column) -> Column:
    """Fold of Gaussian elimination over a symmetric matrix given by its upper
    half, first column first: the half that ``steps`` leave, and before each
    step the last diagonal element (the residual square sum of the columns so
    far) and the pivot."""
    def step(s: Column, _) -> Column:
        first = F.get(s["a"], F.lit(0))
        pivot = F.get(first, F.lit(0))
        below = F.transform(F.slice(s["a"], F.lit(2), F.size(s["a"]) - 1), lambda row, i: F.zip_with(
            row, F.slice(first, i + 2, F.size(row)), lambda v, u: v - F.try_divide(F.get(first, i + 1) * u, pivot)))
        return F.struct(below.alias("a"), F.concat(s["rest"], F.element_at(s["a"], -1)).alias("rest"),
                        F.concat(s["pivots"], F.array(pivot)).alias("pivots"))
    none = F.array().cast("array<double>")
    return F.aggregate(steps, F.struct(half.alias("a"), none.alias("rest"), none.alias("pivots")), step)


def _adf_order(half: Column, e: Column, rows: Column) -> Column:
    """The lag order of least AIC, from the matrix and its elimination up to
    the target; NULL where the regression is not determined."""
    total, ssr = F.get(e["rest"], F.lit(1)), F.slice(F.concat(e["rest"], F.get(e["a"], F.lit(0))), F.lit(3), F.size(half))
    sound = F.forall(ssr, lambda v: v > ADF_TOLERANCE * total) & F.forall(
        F.zip_with(e["pivots"], F.slice(half, F.lit(1), F.size(half) - 1), lambda v, row: v > ADF_TOLERANCE * F.get(row, F.lit(0))),
        lambda ok: ok)
    aic = F.transform(ssr, lambda v, p: rows * (math.log(2 * math.pi) + F.ln(v / rows) + 1.0) + 2 * (p + 2))
    return F.when(sound & (total > 0), _once(aic, lambda values: (F.array_position(values, F.array_min(values)) - 1).cast("int")))


def adf(s: DataFrame, by: list[str] | None = None, order: str = "Date", value: str = "value") -> DataFrame:  # K02
    """Augmented Dickey-Fuller test with a constant per series, the lag order
    chosen by AIC over a common sample. Series that are too short, constant or
    too regular for the regression have NULL in every column.

    A series is one row with its ordered values (bounded by the calendar). Its
    regressions share one matrix of cross moments: the residual square sums of
    the nested lag orders are what successive elimination leaves of the target.
    The chosen order's own, longer sample gets a matrix of its own. Each of the
    two is one expression, written: an inlined fold would run once per use.
    """
    key = list(by or []) or ["_series"]
    df = (s if by else s.withColumn("_series", F.lit("all"))).where(F.col(value).isNotNull())
    point = F.struct(F.col(order).alias("t"), F.col(value).cast("double").alias("v"))
    g = df.groupBy(*key).agg(F.sort_array(F.collect_list(point)).alias("_p"), F.min(F.col(value).cast("double")).alias("_lo"),
                             F.max(F.col(value).cast("double")).alias("_hi"))
    g = materialize(g.select(*key, "_lo", "_hi", F.transform("_p", lambda p: p["v"] - F.col("_lo")).alias("_x")), "adf-series")
    last, first = F.slice("_x", F.lit(2), F.size("_x") - 1), F.slice("_x", F.lit(1), F.size("_x") - 1)
    x = g.where((F.size("_x") >= ADF_MIN_ROWS) & (F.col("_hi") > F.col("_lo"))).select(
        *key, "_x", F.zip_with(last, first, lambda b, a: b - a).alias("_d"), adf_lags(F.size("_x")).alias("_lags"))
    tried = _once(F.struct("_x", "_d", "_lags"), lambda r: _once(
        _half_moments(r["_x"], r["_d"], r["_lags"]), lambda a: _once(
            _eliminated(a, F.sequence(F.lit(0), r["_lags"] + 1)), lambda e: _adf_order(a, e, F.size(r["_d"]) - r["_lags"]))))
    x = materialize(x.select(*key, "_x", "_d", tried.alias("_p")), "adf-orders").where("_p is not null")
    left_of = _once(_half_moments(F.col("_x"), F.col("_d"), F.col("_p"), level_last=True), lambda a: F.struct(
        F.get(F.element_at(a, -2), F.lit(0)).alias("x2"), _eliminated(a, F.sequence(F.lit(0), F.col("_p")))["a"].alias("a")))
    x = materialize(x.select(*key, "_p", (F.size("_d") - F.col("_p")).alias("_rows"), left_of.alias("_e")), "adf-tests")
    level, target = F.get("_e.a", F.lit(0)), F.get("_e.a", F.lit(1))
    x = x.select(*key, "_p", "_rows", F.get(level, F.lit(0)).alias("_xx"), F.get(level, F.lit(1)).alias("_xy"),
                 F.get(target, F.lit(0)).alias("_yy"), F.col("_e.x2").alias("_x2"))
    free, left = F.col("_rows") - F.col("_p") - 2, F.col("_yy") - F.col("_xy") * F.col("_xy") / F.col("_xx")
    stat = F.when((F.col("_xx") > ADF_TOLERANCE * F.col("_x2")) & (free > 0) & (left > 0),
                  F.col("_xy") / F.col("_xx") / F.sqrt(left / free / F.col("_xx")))
    x = x.withColumn("statistic", stat).where("statistic is not null").withColumn("p_value", adf_pvalue(F.col("statistic")))
    one = F.lit(1.0) / F.col("_rows")
    crit = [(((F.lit(c[3]) * one + c[2]) * one + c[1]) * one + c[0]).alias(name) for name, c in ADF_CRIT.items()]
    x = x.select(*key, "statistic", "p_value", F.col("_p").alias("used_lag"), F.col("_rows").cast("int").alias("nobs"),
                 (F.col("p_value") < 0.05).cast("int").alias("is_stationary"), *crit)
    out = g.select(*key).join(x, key, "left")
    return out if by else out.drop("_series")


def difference_if_needed(s: DataFrame, adf_result: DataFrame, by: list[str],
                         order: str = "Date", value: str = "value") -> DataFrame:   # K03
    """Keep stationary series, first-difference the others: (by, Date,
    value_used, differenced). A series without a test result stays as it is."""
    d = first_difference(s, by, order, value).select(*by, order, "diff")
    verdict = adf_result.select(*by, F.coalesce("is_stationary", F.lit(1)).alias("is_stationary"))
    j = s.join(verdict, by).join(d, [*by, order], "left")
    return (j.filter((F.col("is_stationary") == 1) | F.col("diff").isNotNull())
            .select(*by, order, F.when(F.col("is_stationary") == 1, F.col(value).cast("double"))
                    .otherwise(F.col("diff").cast("double")).alias("value_used"),
                    (1 - F.col("is_stationary")).alias("differenced")))


def scaled_positions(s: DataFrame, by: list[str], val_days: int = VAL_DAYS, window: int = WINDOW,
                     order: str = "Date", value: str = "value", min_extra: int = MIN_EXTRA) -> DataFrame:
    """Per series: position, length, hold-out flag and min-max scaling to
    (-1, 1) fitted on the training part only (W08, W09). Series shorter
    than window + val_days + min_extra are dropped."""
    w = Window.partitionBy(*by).orderBy(order)
    whole = Window.partitionBy(*by)
    x = (s.withColumn("pos", F.row_number().over(w) - 1)
         .withColumn("n", F.count(F.lit(1)).over(whole))
         .filter(F.col("n") >= window + val_days + min_extra))
    is_train = F.col("pos") < F.col("n") - val_days
    x = (x.withColumn("split", F.when(is_train, "train").otherwise("valid"))
         .withColumn("lo", F.min(F.when(is_train, F.col(value))).over(whole))
         .withColumn("hi", F.max(F.when(is_train, F.col(value))).over(whole)))
    rng = F.coalesce(F.nullif((F.col("hi") - F.col("lo")).cast("double"), F.lit(0.0)), F.lit(1.0))
    return x.withColumn("scaled", F.lit(2.0) * (F.col(value) - F.col("lo")) / rng - F.lit(1.0))


def inverse_scale(scaled, lo, hi):                                           # W09 inverse
    rng = F.coalesce(F.nullif((hi - lo).cast("double"), F.lit(0.0)), F.lit(1.0))
    return (scaled + F.lit(1.0)) / F.lit(2.0) * rng + lo


def windows(s: DataFrame, by: list[str], window: int = WINDOW, val_days: int = VAL_DAYS,
            order: str = "Date", value: str = "value") -> DataFrame:        # W06 + K06
    """Supervised windows over every series in one pass: for each position
    p >= window, x = scaled values p-window..p-1, y = scaled value at p.
    The split follows the target's position (validation = last val_days),
    so validation windows borrow their context from the training tail."""
    x = scaled_positions(s, by, val_days, window, order, value)
    w = Window.partitionBy(*by).orderBy("pos").rowsBetween(-window, -1)
    return (x.withColumn("x", F.collect_list("scaled").over(w))
            .filter(F.col("pos") >= window)
            .select(*by, order, "split", "x", F.col("scaled").alias("y"), "lo", "hi"))


def window_vectors(wdf: DataFrame, window: int = WINDOW) -> DataFrame:
    """Expose the window array as an ML feature vector column ``features``."""
    from pyspark.ml.functions import array_to_vector
    return wdf.withColumn("features", array_to_vector(F.col("x")))
