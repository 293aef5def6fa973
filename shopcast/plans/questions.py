"""The fourteen analysis questions Q01-Q14 as evidence-table queries.

Inputs come from a ``PanelContext``: T = ``ctx.clean`` (trading rows with
features), R = ``ctx.raw`` (unfiltered joined daily rows), E = ``ctx.test``.
Every function returns a DataFrame; nothing is collected. Rates are
computed from unrounded values (rounding is for display only).

Scale: every table is one or two grouped aggregations over the fact (partial
aggregation before the shuffle) followed by work on the small aggregate;
per-store ratios and ranks are computed at store grain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcast.functions import stats
from shopcast.plans.context import PanelContext
from shopcast.sources.fixture import easter_sunday


def pct(a, b):
    """Percent change; NULL where there is nothing to compare with."""
    return F.lit(100.0) * (F.try_divide(a, b) - 1)


def basket(sales="Sales", customers="Customers"):
    """Sales per customer of a row; NULL when there are no customers."""
    return F.col(sales) / F.nullif(F.col(customers).cast("double"), F.lit(0.0))


def known(df: DataFrame, *cols: str) -> DataFrame:
    """Rows whose store is in the dimension: a missing attribute is no group."""
    return df.filter(" AND ".join(f"{c} IS NOT NULL" for c in cols))


def cnt():
    return F.count(F.lit(1)).cast("bigint")


def sh_flag():
    return (F.coalesce(F.col("StateHoliday").cast("string"), F.lit("0")) != "0").cast("int")


@dataclass
class Finding:
    """Result of one analysis question: evidence tables and a templated insight."""

    key: str
    question: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    insight: str = ""


# --- Q01 promo distribution train vs test ---------------------------------

def _split_stats(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("split"), cnt().alias("rows"),
                  F.avg("Promo").alias("promo_share"),
                  F.avg("SchoolHoliday").alias("school_holiday_share"),
                  F.avg(sh_flag()).alias("state_holiday_share"),
                  F.countDistinct("Store").cast("bigint").alias("stores"))


def q01_split(ctx: PanelContext) -> DataFrame:
    return _split_stats(ctx.clean, "train").unionByName(_split_stats(ctx.test, "test"))


def q01_weekday(ctx: PanelContext) -> DataFrame:
    tr = ctx.clean.groupBy("DayOfWeek").agg(F.avg("Promo").alias("train_promo_share"))
    te = (ctx.test.groupBy((F.weekday("Date") + 1).alias("DayOfWeek"))
          .agg(F.avg("Promo").alias("test_promo_share")))
    return tr.join(te, "DayOfWeek", "full_outer")


def q01_chi2(ctx: PanelContext) -> DataFrame:
    tr = ctx.clean.agg(F.sum("Promo").cast("bigint").alias("train_promo"), cnt().alias("train_rows"))
    te = ctx.test.agg(F.sum("Promo").cast("bigint").alias("test_promo"), cnt().alias("test_rows"))
    j = stats.with_scalars(tr, te)
    a, c = F.col("train_promo"), F.col("test_promo")
    chi2, p = stats.chi2_yates_2x2(a, F.col("train_rows") - a, c, F.col("test_rows") - c)
    return j.select("train_promo", "train_rows", "test_promo", "test_rows",
                    chi2.alias("chi2"), p.alias("p_value"))


# --- Q02 holidays -----------------------------------------------------------

# Labels of the evidence tables.
PHASE_BEFORE, PHASE_DURING, PHASE_AFTER, PHASE_NORMAL = "Before (1-3d)", "During", "After (1-3d)", "Normal"


def holiday_phase():
    return (F.when(F.col("IsStateHoliday") == 1, PHASE_DURING)
            .when(F.col("DaysToNextHoliday") <= 3, PHASE_BEFORE)
            .when(F.col("DaysAfterLastHoliday") <= 3, PHASE_AFTER)
            .otherwise(PHASE_NORMAL))


def q02_phase(ctx: PanelContext) -> DataFrame:
    t = ctx.clean.withColumn("HolidayPhase", holiday_phase())
    g = t.groupBy("HolidayPhase").agg(
        F.avg("Sales").alias("mean_sales"), F.avg("Customers").alias("mean_customers"),
        cnt().alias("trading_days"))
    g = g.join(stats.exact_quantiles(t, "Sales", [0.5], ["median_sales"], ["HolidayPhase"]), "HolidayPhase", "left")
    normal = F.max(F.when(F.col("HolidayPhase") == PHASE_NORMAL, F.col("mean_sales"))).over(Window.partitionBy())
    return g.select("*", pct(F.col("mean_sales"), normal).alias("vs_normal_pct"),
                    (F.try_divide(F.col("mean_sales"), F.col("mean_customers"))).alias("sales_per_customer"))


def q02_profile(ctx: PanelContext) -> DataFrame:
    t = ctx.clean
    to = (t.filter(F.col("DaysToNextHoliday") <= 7)
          .groupBy(F.lit("to_next").alias("kind"), F.col("DaysToNextHoliday").alias("days"))
          .agg(F.avg("Sales").alias("mean_sales"), cnt().alias("n")))
    after = (t.filter(F.col("DaysAfterLastHoliday") <= 7)
             .groupBy(F.lit("after_last").alias("kind"), F.col("DaysAfterLastHoliday").alias("days"))
             .agg(F.avg("Sales").alias("mean_sales"), cnt().alias("n")))
    return to.unionByName(after)


# --- Q03 seasonality --------------------------------------------------------

def q03_month(ctx: PanelContext) -> DataFrame:
    g = ctx.clean.groupBy("Month").agg(F.avg("Sales").alias("mean_sales"),
                                       F.sum("Sales").alias("_s"), F.count(F.lit(1)).alias("_n"))
    overall = F.sum("_s").over(Window.partitionBy()) / F.sum("_n").over(Window.partitionBy())
    return g.select("Month", "mean_sales", F.try_divide(F.col("mean_sales"), overall).alias("index_vs_year"))


def q03_year_month(ctx: PanelContext) -> DataFrame:
    return ctx.clean.groupBy("Year", "Month").agg(F.avg("Sales").alias("mean_sales"))


def q03_december(ctx: PanelContext) -> DataFrame:
    g = ctx.clean.filter(F.col("Month") == 12).groupBy("Day").agg(F.avg("Sales").alias("mean_sales"))
    top = F.max("mean_sales").over(Window.partitionBy())
    return g.select("Day", "mean_sales", (F.col("mean_sales") == top).cast("int").alias("is_peak"))


def q03_easter(ctx: PanelContext, span: int = 14) -> DataFrame:
    """Mean sales by signed days from Easter Sunday, for every year; so near
    to Easter the year's own one is the nearest."""
    t = ctx.clean.withColumn("DaysFromEaster", F.datediff("Date", easter_sunday(F.year("Date"))))
    return (t.filter(F.col("DaysFromEaster").between(-span, span)).groupBy("DaysFromEaster")
            .agg(F.avg("Sales").alias("mean_sales"), cnt().alias("n")))


# --- Q04 sales vs customers ---------------------------------------------------

def q04_corr(ctx: PanelContext) -> DataFrame:
    t = ctx.clean.select("Sales", "Customers")
    p = t.agg(F.corr("Sales", "Customers").alias("pearson"), cnt().alias("n"))
    s = stats.spearman(t, "Sales", "Customers").select("spearman")
    return stats.with_scalars(p, s).select("pearson", "spearman",
                                          F.pow("pearson", 2).alias("r2"), "n")


def q04_by_type(ctx: PanelContext) -> DataFrame:
    return known(ctx.clean, "StoreType").groupBy("StoreType").agg(
        F.corr("Sales", "Customers").alias("corr"), F.avg(basket()).alias("mean_basket"),
        F.avg("Sales").alias("mean_sales"), F.avg("Customers").alias("mean_customers"))


def q04_fit(ctx: PanelContext) -> DataFrame:
    fit = ctx.clean.agg(F.regr_slope("Sales", "Customers").alias("slope"),
                        F.regr_intercept("Sales", "Customers").alias("intercept"))
    # both columns ranked in one pass, stacked as (column, value) rows
    long = ctx.clean.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in ("Sales", "Customers")
    ])).alias("_p")).select("_p._col", "_p._x")
    q = stats.exact_quantiles(long, "_x", [0.999], ["_q"], by=["_col"])
    qs = q.agg(F.max(F.when(F.col("_col") == "Sales", F.col("_q"))).alias("q999_sales"),
               F.max(F.when(F.col("_col") == "Customers", F.col("_q"))).alias("q999_customers"))
    return stats.with_scalars(fit, qs).select("slope", "intercept", "q999_sales", "q999_customers")


# --- Q05 promo effect -------------------------------------------------------

def q05_promo(ctx: PanelContext) -> DataFrame:
    return ctx.clean.filter(F.col("DayOfWeek") <= 5).groupBy("Promo").agg(
        F.avg("Sales").alias("mean_sales"), F.avg("Customers").alias("mean_customers"),
        F.avg(basket()).alias("mean_basket"), cnt().alias("days"))


def q05_decomposition(ctx: PanelContext) -> DataFrame:
    w = ctx.clean.filter(F.col("DayOfWeek") <= 5)

    def m(col, promo):
        return F.avg(F.when(F.col("Promo") == promo, col))
    g = w.agg(m(F.col("Sales"), 1).alias("s1"), m(F.col("Sales"), 0).alias("s0"),
              m(F.col("Customers"), 1).alias("c1"), m(F.col("Customers"), 0).alias("c0"),
              m(basket(), 1).alias("b1"), m(basket(), 0).alias("b0"))
    ls, lc, lb = pct(F.col("s1"), F.col("s0")), pct(F.col("c1"), F.col("c0")), pct(F.col("b1"), F.col("b0"))
    return g.select(ls.alias("lift_sales_pct"), lc.alias("lift_customers_pct"), lb.alias("lift_basket_pct"),
                    (100 * F.try_divide(F.log1p(lc / 100), F.log1p(ls / 100))).alias("share_customers_pct"),
                    (100 * F.try_divide(F.log1p(lb / 100), F.log1p(ls / 100))).alias("share_basket_pct"))


# --- Q06 promo targeting ----------------------------------------------------

def q06_uplift(ctx: PanelContext) -> DataFrame:
    w = ctx.clean.filter(F.col("DayOfWeek") <= 5)
    g = w.groupBy("Store").agg(
        F.avg(F.when(F.col("Promo") == 0, F.col("Sales"))).alias("no_promo"),
        F.avg(F.when(F.col("Promo") == 1, F.col("Sales"))).alias("promo"),
        F.count(F.when(F.col("Promo") == 1, F.lit(1))).cast("bigint").alias("promo_days"),
        F.min("StoreType").alias("StoreType"), F.min("Assortment").alias("Assortment"))
    g = g.filter(F.col("no_promo").isNotNull() & F.col("promo").isNotNull())
    ab = F.col("promo") - F.col("no_promo")
    return g.select("Store", "no_promo", "promo", ab.alias("abs_uplift"),
                    pct(F.col("promo"), F.col("no_promo")).alias("pct_uplift"), "promo_days",
                    (ab * F.col("promo_days")).alias("total_incremental"), "StoreType", "Assortment")


def q06_top(ctx: PanelContext, top_n: int = 15) -> DataFrame:
    return q06_uplift(ctx).orderBy(F.desc("abs_uplift"), F.asc("Store")).limit(top_n)


# Labels of the evidence tables.
QUARTILE_LABELS = ["Q1 (lowest)", "Q2", "Q3", "Q4 (highest)"]


def q06_quartiles(ctx: PanelContext) -> DataFrame:
    u = q06_uplift(ctx)
    edges = stats.with_scalars(
        stats.exact_quantiles(u, "abs_uplift", [0.25, 0.5, 0.75], ["_e0", "_e1", "_e2"]),
        u.agg(F.sum("total_incremental").alias("_total")))
    j = stats.with_scalars(u, edges)
    q = stats.qcut_index(F.col("abs_uplift"), [F.col("_e0"), F.col("_e1"), F.col("_e2")])
    labels = F.element_at(F.array(*[F.lit(x) for x in QUARTILE_LABELS]), q + 1)
    return j.groupBy(labels.alias("uplift_quartile"), "_total").agg(
        cnt().alias("stores"), F.avg("abs_uplift").alias("mean_abs_uplift"),
        F.avg("pct_uplift").alias("mean_pct_uplift"),
        (100 * F.try_divide(F.sum("total_incremental"), F.first("_total"))).alias("share_of_total_incremental")
    ).drop("_total")


def q06_corr(ctx: PanelContext) -> DataFrame:
    return q06_uplift(ctx).agg(F.corr("no_promo", "abs_uplift").alias("corr_baseline_uplift"),
                               cnt().alias("stores"))


# --- Q07 open / close -------------------------------------------------------

def q07_weekday(ctx: PanelContext) -> DataFrame:
    return ctx.raw.groupBy("DayOfWeek").agg(
        F.avg("Open").alias("open_rate"),
        F.avg(F.when(F.col("Open") == 1, F.col("Sales"))).alias("mean_sales_open"),
        F.avg(F.when(F.col("Open") == 1, F.col("Customers"))).alias("mean_customers_open"),
        (100 * (1 - F.avg("Open"))).alias("closed_share_pct"))


def q07_type_weekday(ctx: PanelContext) -> DataFrame:
    p = known(ctx.raw, "StoreType").groupBy("StoreType").pivot("DayOfWeek", list(range(1, 8))).agg(F.avg("Open"))
    return p.select("StoreType", *[F.col(str(d)).alias(f"dow{d}") for d in range(1, 8)])


# --- Q08 weekday openers and weekend sales ----------------------------------

# Labels of the evidence tables.
SEG_ALL, SEG_CLOSURES = "Opens all weekdays", "Has weekday closures"


def _segments(ctx: PanelContext, threshold: float | None) -> DataFrame:
    threshold = ctx.opener_threshold if threshold is None else threshold
    rate = (ctx.raw.filter(F.col("DayOfWeek") <= 5).groupBy("Store").agg(F.avg("Open").alias("open_rate")))
    return rate.select("Store", F.when(F.col("open_rate") >= threshold, SEG_ALL)
                       .otherwise(SEG_CLOSURES).alias("Segment"))


def q08_segments(ctx: PanelContext, threshold: float | None = None) -> DataFrame:
    work = ctx.raw.filter(F.col("Open") == 1).join(_segments(ctx, threshold), "Store")
    g = work.groupBy("Segment").agg(
        F.countDistinct("Store").cast("bigint").alias("stores"),
        F.avg(F.when(F.col("DayOfWeek") <= 5, F.col("Sales"))).alias("mean_weekday_sales"),
        F.avg(F.when(F.col("DayOfWeek") == 6, F.col("Sales"))).alias("mean_saturday_sales"),
        F.avg(F.when(F.col("DayOfWeek") == 7, F.col("Sales"))).alias("mean_sunday_sales"))
    return g.withColumn("sat_vs_weekday_pct", pct(F.col("mean_saturday_sales"), F.col("mean_weekday_sales")))


def store_sat_ratio(ctx: PanelContext, threshold: float | None = None) -> DataFrame:
    work = ctx.raw.filter(F.col("Open") == 1)
    r = work.groupBy("Store").agg(
        F.try_divide(F.avg(F.when(F.col("DayOfWeek") == 6, F.col("Sales"))),
                     F.avg(F.when(F.col("DayOfWeek") <= 5, F.col("Sales")))).alias("ratio"))
    return r.filter(F.col("ratio").isNotNull()).join(_segments(ctx, threshold), "Store")


def q08_ratio(ctx: PanelContext, threshold: float | None = None) -> DataFrame:
    return stats.box_summary(store_sat_ratio(ctx, threshold), "ratio", ["Segment"]) \
        .withColumn("n", F.col("n").cast("bigint")).withColumn("fliers", F.col("fliers").cast("bigint"))


def q08_mann_whitney(ctx: PanelContext, threshold: float | None = None) -> DataFrame:
    return stats.mann_whitney(store_sat_ratio(ctx, threshold), "ratio", "Segment", SEG_ALL, SEG_CLOSURES)


# --- Q09 assortment ---------------------------------------------------------

def q09_assortment(ctx: PanelContext) -> DataFrame:
    t = known(ctx.clean, "Assortment")
    g = t.groupBy("Assortment").agg(
        F.countDistinct("Store").cast("bigint").alias("stores"), F.avg("Sales").alias("mean_sales"),
        F.avg("Customers").alias("mean_customers"))
    g = g.join(stats.exact_quantiles(t, "Sales", [0.5], ["median_sales"], ["Assortment"]),
               "Assortment", "left")
    return g.withColumn("sales_per_customer", F.try_divide(F.col("mean_sales"), F.col("mean_customers")))


def q09_cross(ctx: PanelContext) -> DataFrame:
    return known(ctx.clean, "StoreType", "Assortment").groupBy("StoreType", "Assortment").agg(
        F.avg("Sales").alias("mean_sales"), F.countDistinct("Store").cast("bigint").alias("stores"))


# --- Q10 competition distance -----------------------------------------------

# Distance bands (right-closed) and their labels.
DISTANCE_EDGES = [0, 250, 500, 1000, 2500, 5000, 10000, float("inf")]
DISTANCE_LABELS = ["<250m", "250-500m", "500m-1km", "1-2.5km", "2.5-5km", "5-10km", ">10km"]
CITY_CENTRE = 500


def q10_bands(ctx: PanelContext) -> DataFrame:
    w = ctx.clean.filter(F.col("HasCompetition") == 1)
    band = stats.right_closed_bin(F.col("CompetitionDistance"), DISTANCE_EDGES, DISTANCE_LABELS)
    g = (w.filter(band.isNotNull())
         .groupBy(band.alias("DistanceBand"),
                  stats.right_closed_ordinal(F.col("CompetitionDistance"), DISTANCE_EDGES).alias("band_order"))
         .agg(F.countDistinct("Store").cast("bigint").alias("stores"), F.avg("Sales").alias("mean_sales"),
              F.avg("Customers").alias("mean_customers")))
    return g.withColumn("sales_per_customer", F.try_divide(F.col("mean_sales"), F.col("mean_customers")))


def q10_spearman(ctx: PanelContext) -> DataFrame:
    st = (ctx.clean.filter(F.col("HasCompetition") == 1).groupBy("Store")
          .agg(F.avg("Sales").alias("mean_sales"), F.min("CompetitionDistance").alias("distance")))
    scoped = (st.withColumn("scope", F.lit("all"))
              .unionByName(st.withColumn("scope", F.when(F.col("distance") <= CITY_CENTRE, "le_500")
                                         .otherwise("gt_500"))))
    return stats.spearman(scoped, "distance", "mean_sales", by=["scope"]) \
        .withColumnRenamed("n", "stores").withColumn("stores", F.col("stores").cast("bigint"))


# --- Q11 competitor opening event study -------------------------------------

# Labels of the evidence tables.
EVENT_LABELS = ["-90 to -60", "-60 to -30", "-30 to 0", "0 to 30", "30 to 60", "60 to 90"]


def competitor_events(ctx: PanelContext, window: int = 90) -> DataFrame:
    """Rows within ``window`` days of a competitor's opening in the years that
    the panel covers."""
    years = ctx.clean.agg(F.min("Year").alias("_from"), F.max("Year").alias("_to"))
    t = stats.with_scalars(ctx.clean, years).filter(F.col("CompetitionOpenSinceYear").between(F.col("_from"), F.col("_to")))
    open_date = F.make_date(F.col("CompetitionOpenSinceYear"),
                            F.greatest(F.col("CompetitionOpenSinceMonth"), F.lit(1)), F.lit(1))
    e = (t.withColumn("DaysSinceCompetitor", F.datediff(F.col("Date"), open_date))
         .filter(F.col("DaysSinceCompetitor").between(-window, window)))
    pre = Window.partitionBy("Store")  # one store's rows in +-window days: bounded
    e = e.withColumn("PreMean", F.avg(F.when(F.col("DaysSinceCompetitor") < 0, F.col("Sales"))).over(pre))
    return e.filter(F.col("PreMean").isNotNull()).withColumn("RelSales", F.try_divide(F.col("Sales"), F.col("PreMean")))


def q11_buckets(ctx: PanelContext, window: int = 90) -> DataFrame:
    e = competitor_events(ctx, window)
    edges = [-window, -60, -30, 0, 30, 60, window]
    b = stats.right_closed_bin(F.col("DaysSinceCompetitor"), edges, EVENT_LABELS)
    return (e.filter(b.isNotNull())
            .groupBy(b.alias("Bucket"), stats.right_closed_ordinal(F.col("DaysSinceCompetitor"), edges)
                     .alias("bucket_order"))
            .agg(F.countDistinct("Store").cast("bigint").alias("stores"),
                 F.avg("RelSales").alias("mean_relative_sales"), F.avg("Sales").alias("mean_sales")))


def q11_curve(ctx: PanelContext, window: int = 90, roll: int = 14, min_periods: int = 5) -> DataFrame:
    d = (competitor_events(ctx, window).groupBy("DaysSinceCompetitor")
         .agg(F.avg("RelSales").alias("mean_relative_sales")))
    # Centred rolling mean over rows ordered by day; at most 2*window+1 rows.
    w = Window.orderBy("DaysSinceCompetitor").rowsBetween(-(roll // 2), roll - roll // 2 - 1)
    return d.select("DaysSinceCompetitor", "mean_relative_sales",
                    F.when(F.count("mean_relative_sales").over(w) >= min_periods,
                           F.avg("mean_relative_sales").over(w)).alias("smoothed"))


# --- Q12 store variance -----------------------------------------------------

def _store_means(ctx: PanelContext) -> DataFrame:
    return ctx.clean.groupBy("Store").agg(F.avg("Sales").alias("store_mean"), F.count(F.lit(1)).alias("n"))


def q12_variance(ctx: PanelContext) -> DataFrame:
    t = ctx.clean
    g = t.agg(F.avg("Sales").alias("grand_mean"), F.var_pop("Sales").alias("_tot"))
    s = stats.with_scalars(_store_means(ctx), g)
    return s.agg(
        F.try_divide(F.sum(F.col("n") * F.pow(F.col("store_mean") - F.col("grand_mean"), 2)) / F.sum("n"),
                     F.first("_tot")).alias("share_between"),
        F.first("grand_mean").alias("grand_mean"),
        F.min("store_mean").alias("min_store_mean"), F.max("store_mean").alias("max_store_mean"))


def q12_by_type(ctx: PanelContext) -> DataFrame:
    g = known(ctx.clean, "StoreType").groupBy("StoreType").agg(
        F.countDistinct("Store").cast("bigint").alias("stores"), F.avg("Sales").alias("mean_sales"),
        F.stddev_samp("Sales").alias("std_sales"), F.avg("Customers").alias("mean_customers"))
    return g.withColumn("cv", F.try_divide(F.col("std_sales"), F.col("mean_sales")))


def q12_hist(ctx: PanelContext, bins: int = 50) -> DataFrame:
    return stats.histogram(_store_means(ctx), "store_mean", bins).withColumn("count", F.col("count").cast("bigint"))


# --- Q13 Promo2 -------------------------------------------------------------

def q13_active(ctx: PanelContext) -> DataFrame:
    g = ctx.clean.filter(F.col("Promo2") == 1).groupBy("IsPromo2Active").agg(
        F.avg("Sales").alias("mean_sales"), F.avg("Customers").alias("mean_customers"), cnt().alias("days"))
    base = F.max(F.when(F.col("IsPromo2Active") == 0, F.col("mean_sales"))).over(Window.partitionBy())
    return g.withColumn("lift_vs_dormant_pct", pct(F.col("mean_sales"), base))


def q13_participation(ctx: PanelContext) -> DataFrame:
    g = ctx.clean.groupBy("Promo2").agg(F.avg("Sales").alias("mean_sales"), cnt().alias("days"))
    base = F.max(F.when(F.col("Promo2") == 0, F.col("mean_sales"))).over(Window.partitionBy())
    return g.withColumn("gap_vs_non_participants_pct", pct(F.col("mean_sales"), base))


# --- Q14 data quality -------------------------------------------------------

def q14_quality(ctx: PanelContext) -> DataFrame:
    """Issue counts and shares: one conditional aggregate per frame, unpivoted."""
    def issues(df: DataFrame, flags: list) -> DataFrame:
        one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f.cast("int")).cast("bigint").alias(f"_c{o}") for o, _, f in flags])
        rows = F.array(*[F.struct(F.lit(o).alias("issue_order"), F.lit(name).alias("issue"), F.col(f"_c{o}").alias("count"),
                                  (100 * F.try_divide(F.col(f"_c{o}"), F.col("_n"))).alias("pct")) for o, name, _ in flags])
        return one.select(F.inline(rows))
    # Names of the issues.
    r = issues(ctx.raw, [
        (1, "Closed store-days (Open=0)", F.col("Open") == 0),
        (2, "Open but zero sales", (F.col("Open") == 1) & (F.col("Sales") == 0)),
        (4, "Missing CompetitionDistance", F.col("CompetitionDistance").isNull()),
        (5, "Missing CompetitionOpenSince*", F.col("CompetitionOpenSinceYear").isNull()),
        (6, "Missing Promo2Since* / PromoInterval", F.col("PromoInterval").isNull())])
    return r.unionByName(issues(ctx.test, [(3, "Missing Open in test", F.col("Open").isNull())]))


def q14_skew(ctx: PanelContext) -> DataFrame:
    o = ctx.raw.filter(F.col("Open") == 1)
    m = stats.exact_quantiles(o, "Sales", [0.5], ["median_sales"])
    return stats.with_scalars(o.agg(stats.corrected_skewness(F.col("Sales")).alias("skew"), cnt().alias("n")),
                              m).select("median_sales", "skew", "n")


def q14_hist(ctx: PanelContext, bins: int = 80) -> DataFrame:
    o = ctx.raw.filter(F.col("Open") == 1).select(F.col("Sales").cast("double").alias("Sales"))
    return stats.histogram(o, "Sales", bins).withColumn("count", F.col("count").cast("bigint"))


QUESTIONS = {
    "q01_split": q01_split, "q01_weekday": q01_weekday, "q01_chi2": q01_chi2,
    "q02_phase": q02_phase, "q02_profile": q02_profile,
    "q03_month": q03_month, "q03_year_month": q03_year_month, "q03_december": q03_december,
    "q03_easter": q03_easter,
    "q04_corr": q04_corr, "q04_by_type": q04_by_type, "q04_fit": q04_fit,
    "q05_promo": q05_promo, "q05_decomposition": q05_decomposition,
    "q06_uplift": q06_uplift, "q06_top": q06_top, "q06_quartiles": q06_quartiles, "q06_corr": q06_corr,
    "q07_weekday": q07_weekday, "q07_type_weekday": q07_type_weekday,
    "q08_segments": q08_segments, "q08_ratio": q08_ratio, "q08_mann_whitney": q08_mann_whitney,
    "q09_assortment": q09_assortment, "q09_cross": q09_cross,
    "q10_bands": q10_bands, "q10_spearman": q10_spearman,
    "q11_buckets": q11_buckets, "q11_curve": q11_curve,
    "q12_variance": q12_variance, "q12_by_type": q12_by_type, "q12_hist": q12_hist,
    "q13_active": q13_active, "q13_participation": q13_participation,
    "q14_quality": q14_quality, "q14_skew": q14_skew, "q14_hist": q14_hist,
}
