"""SQL twins (DuckDB dialect) of the Q01-Q14 evidence tables."""

from __future__ import annotations

from shopcast.plans.oracle import EASTER, with_raw, with_t


def erfc_sql(z: str) -> str:
    """erfc(z) for z >= 0 by another way than the code under test: the mean of
    exp(-z^2 / sin^2 t) over t in (0, pi/2), by the midpoint rule."""
    return (f"(SELECT avg(exp(-pow({z}, 2) / pow(sin((k + 0.5E0) * pi() / 8000.0E0), 2))) FROM range(4000) AS steps(k))")


def compared_sql(c: str) -> str:
    """The comparison rounding of the catalogue, as SQL."""
    return (f"CASE WHEN abs({c}) >= 1.0E15 THEN {c} WHEN abs({c}) >= 1.0E9 THEN floor({c} * 100.0E0 + 0.5E0) / 100.0E0 "
            f"WHEN abs({c}) >= 1.0E-3 THEN floor({c} * 1000000.0E0 + 0.5E0) / 1000000.0E0 "
            f"ELSE floor({c} * 1000000000000000.0E0 + 0.5E0) / 1000000000000000.0E0 END")


def final(body: str, doubles: list[str], base=with_t, extra: str = "") -> str:
    """Wrap ``body`` as the last CTE and round its double columns."""
    rep = ", ".join(f"{compared_sql(c)} AS {c}" for c in doubles)
    sel = f"SELECT * REPLACE ({rep}) FROM _q" if doubles else "SELECT * FROM _q"
    return base(f"{extra}, _q AS ({body})\n{sel}")


BASKET = "CAST(Sales AS DOUBLE) / NULLIF(CAST(Customers AS DOUBLE), 0)"
SH = "CASE WHEN COALESCE(StateHoliday, '0') <> '0' THEN 1 ELSE 0 END"
PHASE = """CASE WHEN IsStateHoliday = 1 THEN 'During' WHEN DaysToNextHoliday <= 3 THEN 'Before (1-3d)'
  WHEN DaysAfterLastHoliday <= 3 THEN 'After (1-3d)' ELSE 'Normal' END"""


def _rank(x, part=""):
    p = f"PARTITION BY {part} " if part else ""
    o = f"{part}, " if part else ""
    return (f"(rank() OVER ({p}ORDER BY {x}) + (count(*) OVER (PARTITION BY {o}{x}) - 1) / 2.0E0)")


SEG = """, seg AS (
  SELECT Store, CASE WHEN avg(Open) >= 0.22 THEN 'Opens all weekdays' ELSE 'Has weekday closures' END AS Segment
  FROM R WHERE DayOfWeek <= 5 GROUP BY Store),
ratio AS (
  SELECT r.Store, s.Segment, r.ratio FROM (
    SELECT Store, avg(Sales) FILTER (WHERE DayOfWeek = 6) / avg(Sales) FILTER (WHERE DayOfWeek <= 5) AS ratio
    FROM R WHERE Open = 1 GROUP BY Store) r JOIN seg s ON s.Store = r.Store WHERE r.ratio IS NOT NULL)"""

EVENTS = """, ev0 AS (
  SELECT *, CAST(date_diff('day', make_date(CompetitionOpenSinceYear, GREATEST(CompetitionOpenSinceMonth, 1), 1), Date)
    AS INTEGER) AS DaysSinceCompetitor
  FROM T WHERE CompetitionOpenSinceYear BETWEEN (SELECT min(Year) FROM T) AND (SELECT max(Year) FROM T)),
ev1 AS (
  SELECT *, avg(CASE WHEN DaysSinceCompetitor < 0 THEN Sales END) OVER (PARTITION BY Store) AS PreMean
  FROM ev0 WHERE DaysSinceCompetitor BETWEEN -90 AND 90),
ev AS (SELECT *, Sales / PreMean AS RelSales FROM ev1 WHERE PreMean IS NOT NULL)"""

UPLIFT = """, up0 AS (
  SELECT Store, avg(Sales) FILTER (WHERE Promo = 0) AS no_promo, avg(Sales) FILTER (WHERE Promo = 1) AS promo,
    CAST(count(*) FILTER (WHERE Promo = 1) AS BIGINT) AS promo_days, min(StoreType) AS StoreType,
    min(Assortment) AS Assortment
  FROM T WHERE DayOfWeek <= 5 GROUP BY Store),
up AS (
  SELECT Store, no_promo, promo, promo - no_promo AS abs_uplift, 100.0E0 * (promo / no_promo - 1) AS pct_uplift,
    promo_days, (promo - no_promo) * promo_days AS total_incremental, StoreType, Assortment
  FROM up0 WHERE no_promo IS NOT NULL AND promo IS NOT NULL)"""


def _hist(src: str, x: str, bins: int) -> str:
    return f"""
  SELECT bin, mn + bin * (mx - mn) / {bins} AS lo, mn + (bin + 1) * (mx - mn) / {bins} AS hi, count
  FROM (SELECT CAST(CASE WHEN mx = mn THEN 0 ELSE LEAST(floor((x - mn) / (mx - mn) * {bins}), {bins - 1}) END AS INTEGER) AS bin,
          mn, mx, CAST(count(*) AS BIGINT) AS count
        FROM (SELECT CAST({x} AS DOUBLE) AS x, min(CAST({x} AS DOUBLE)) OVER () AS mn,
                     max(CAST({x} AS DOUBLE)) OVER () AS mx FROM {src} WHERE {x} IS NOT NULL)
        GROUP BY 1, 2, 3)"""


def question_sql() -> dict[str, str]:
    q = {}
    q["q01_split"] = final(f"""
  SELECT 'train' AS split, CAST(count(*) AS BIGINT) AS rows, avg(Promo) AS promo_share,
    avg(SchoolHoliday) AS school_holiday_share, avg({SH}) AS state_holiday_share,
    CAST(count(DISTINCT Store) AS BIGINT) AS stores FROM T
  UNION ALL
  SELECT 'test', CAST(count(*) AS BIGINT), avg(Promo), avg(SchoolHoliday), avg({SH}),
    CAST(count(DISTINCT Store) AS BIGINT) FROM E""",
                           ["promo_share", "school_holiday_share", "state_holiday_share"])
    q["q01_weekday"] = final("""
  SELECT COALESCE(a.DayOfWeek, b.DayOfWeek) AS DayOfWeek, a.train_promo_share, b.test_promo_share
  FROM (SELECT DayOfWeek, avg(Promo) AS train_promo_share FROM T GROUP BY 1) a
  FULL OUTER JOIN (SELECT CAST(isodow(Date) AS INTEGER) AS DayOfWeek, avg(Promo) AS test_promo_share
                   FROM E GROUP BY 1) b ON a.DayOfWeek = b.DayOfWeek""",
                             ["train_promo_share", "test_promo_share"])
    chi = ("n * pow(GREATEST(abs(a * d - b * c) - n / 2, 0.0E0), 2) / ((a + b) * (c + d) * (a + c) * (b + d))")
    q["q01_chi2"] = final(f"""
  SELECT train_promo, train_rows, test_promo, test_rows, chi2, {erfc_sql('sqrt(chi2 / 2)')} AS p_value
  FROM (SELECT *, {chi} AS chi2 FROM (
    SELECT *, CAST(train_promo AS DOUBLE) AS a, CAST(train_rows - train_promo AS DOUBLE) AS b,
      CAST(test_promo AS DOUBLE) AS c, CAST(test_rows - test_promo AS DOUBLE) AS d,
      CAST(train_rows + test_rows AS DOUBLE) AS n
    FROM (SELECT CAST(sum(Promo) AS BIGINT) AS train_promo, CAST(count(*) AS BIGINT) AS train_rows FROM T),
         (SELECT CAST(sum(Promo) AS BIGINT) AS test_promo, CAST(count(*) AS BIGINT) AS test_rows FROM E)))""",
                          ["chi2", "p_value"])
    q["q02_phase"] = final(f"""
  SELECT *, 100.0E0 * (mean_sales / max(CASE WHEN HolidayPhase = 'Normal' THEN mean_sales END) OVER () - 1)
      AS vs_normal_pct, mean_sales / mean_customers AS sales_per_customer
  FROM (SELECT {PHASE} AS HolidayPhase, avg(Sales) AS mean_sales, quantile_cont(Sales, 0.5) AS median_sales,
          avg(Customers) AS mean_customers, CAST(count(*) AS BIGINT) AS trading_days FROM T GROUP BY 1)""",
                           ["mean_sales", "median_sales", "mean_customers", "vs_normal_pct", "sales_per_customer"])
    q["q02_profile"] = final("""
  SELECT 'to_next' AS kind, DaysToNextHoliday AS days, avg(Sales) AS mean_sales, CAST(count(*) AS BIGINT) AS n
  FROM T WHERE DaysToNextHoliday <= 7 GROUP BY 2
  UNION ALL
  SELECT 'after_last', DaysAfterLastHoliday, avg(Sales), CAST(count(*) AS BIGINT)
  FROM T WHERE DaysAfterLastHoliday <= 7 GROUP BY 2""", ["mean_sales"])
    q["q03_month"] = final("""
  SELECT Month, avg(Sales) AS mean_sales, avg(Sales) / (SELECT avg(Sales) FROM T) AS index_vs_year
  FROM T GROUP BY Month""", ["mean_sales", "index_vs_year"])
    q["q03_year_month"] = final("""
  SELECT Year, Month, avg(Sales) AS mean_sales FROM T GROUP BY Year, Month""", ["mean_sales"])
    q["q03_december"] = final("""
  SELECT Day, mean_sales, CAST(CASE WHEN mean_sales = max(mean_sales) OVER () THEN 1 ELSE 0 END AS INTEGER) AS is_peak
  FROM (SELECT Day, avg(Sales) AS mean_sales FROM T WHERE Month = 12 GROUP BY Day)""", ["mean_sales"])
    q["q03_easter"] = final(f"""
  SELECT DaysFromEaster, avg(Sales) AS mean_sales, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT Sales, CAST(date_diff('day', sunday, Date) AS INTEGER) AS DaysFromEaster FROM T JOIN {EASTER} ON y = Year)
  WHERE DaysFromEaster BETWEEN -14 AND 14 GROUP BY 1""", ["mean_sales"])
    q["q04_corr"] = final(f"""
  SELECT corr(Sales, Customers) AS pearson, corr(rx, ry) AS spearman, pow(corr(Sales, Customers), 2) AS r2,
    CAST(count(*) AS BIGINT) AS n
  FROM (SELECT Sales, Customers, {_rank('Sales')} AS rx, {_rank('Customers')} AS ry FROM T)""",
                          ["pearson", "spearman", "r2"])
    q["q04_by_type"] = final(f"""
  SELECT StoreType, corr(Sales, Customers) AS corr, avg({BASKET}) AS mean_basket, avg(Sales) AS mean_sales,
    avg(Customers) AS mean_customers FROM T GROUP BY StoreType""",
                             ["corr", "mean_basket", "mean_sales", "mean_customers"])
    q["q04_fit"] = final("""
  SELECT regr_slope(Sales, Customers) AS slope, regr_intercept(Sales, Customers) AS intercept,
    quantile_cont(Sales, 0.999) AS q999_sales, quantile_cont(Customers, 0.999) AS q999_customers FROM T""",
                         ["slope", "intercept", "q999_sales", "q999_customers"])
    q["q05_promo"] = final(f"""
  SELECT Promo, avg(Sales) AS mean_sales, avg(Customers) AS mean_customers, avg({BASKET}) AS mean_basket,
    CAST(count(*) AS BIGINT) AS days FROM T WHERE DayOfWeek <= 5 GROUP BY Promo""",
                           ["mean_sales", "mean_customers", "mean_basket"])
    q["q05_decomposition"] = final(f"""
  SELECT ls AS lift_sales_pct, lc AS lift_customers_pct, lb AS lift_basket_pct,
    100.0E0 * ln(1 + lc / 100) / ln(1 + ls / 100) AS share_customers_pct,
    100.0E0 * ln(1 + lb / 100) / ln(1 + ls / 100) AS share_basket_pct
  FROM (SELECT 100.0E0 * (s1 / s0 - 1) AS ls, 100.0E0 * (c1 / c0 - 1) AS lc, 100.0E0 * (b1 / b0 - 1) AS lb
        FROM (SELECT avg(Sales) FILTER (WHERE Promo = 1) AS s1, avg(Sales) FILTER (WHERE Promo = 0) AS s0,
                avg(Customers) FILTER (WHERE Promo = 1) AS c1, avg(Customers) FILTER (WHERE Promo = 0) AS c0,
                avg({BASKET}) FILTER (WHERE Promo = 1) AS b1, avg({BASKET}) FILTER (WHERE Promo = 0) AS b0
              FROM T WHERE DayOfWeek <= 5))""",
                                   ["lift_sales_pct", "lift_customers_pct", "lift_basket_pct",
                                    "share_customers_pct", "share_basket_pct"])
    up_d = ["no_promo", "promo", "abs_uplift", "pct_uplift", "total_incremental"]
    q["q06_uplift"] = final("SELECT * FROM up", up_d, extra=UPLIFT)
    q["q06_top"] = final("SELECT * FROM up ORDER BY abs_uplift DESC, Store LIMIT 15", up_d, extra=UPLIFT)
    q["q06_quartiles"] = final("""
  SELECT CASE WHEN abs_uplift <= e1 THEN 'Q1 (lowest)' WHEN abs_uplift <= e2 THEN 'Q2'
              WHEN abs_uplift <= e3 THEN 'Q3' ELSE 'Q4 (highest)' END AS uplift_quartile,
    CAST(count(*) AS BIGINT) AS stores, avg(abs_uplift) AS mean_abs_uplift, avg(pct_uplift) AS mean_pct_uplift,
    100.0E0 * sum(total_incremental) / min(total) AS share_of_total_incremental
  FROM up, (SELECT quantile_cont(abs_uplift, 0.25) AS e1, quantile_cont(abs_uplift, 0.5) AS e2,
                   quantile_cont(abs_uplift, 0.75) AS e3, sum(total_incremental) AS total FROM up)
  GROUP BY 1""", ["mean_abs_uplift", "mean_pct_uplift", "share_of_total_incremental"], extra=UPLIFT)
    q["q06_corr"] = final("""
  SELECT corr(no_promo, abs_uplift) AS corr_baseline_uplift, CAST(count(*) AS BIGINT) AS stores FROM up""",
                          ["corr_baseline_uplift"], extra=UPLIFT)
    q["q07_weekday"] = final("""
  SELECT DayOfWeek, avg(Open) AS open_rate, avg(Sales) FILTER (WHERE Open = 1) AS mean_sales_open,
    avg(Customers) FILTER (WHERE Open = 1) AS mean_customers_open, 100.0E0 * (1 - avg(Open)) AS closed_share_pct
  FROM R GROUP BY DayOfWeek""", ["open_rate", "mean_sales_open", "mean_customers_open", "closed_share_pct"],
                             base=with_raw)
    q["q07_type_weekday"] = final(
        "SELECT StoreType, " + ", ".join(f"avg(Open) FILTER (WHERE DayOfWeek = {d}) AS dow{d}" for d in range(1, 8))
        + " FROM R GROUP BY StoreType", [f"dow{d}" for d in range(1, 8)], base=with_raw)
    q["q08_segments"] = final("""
  SELECT Segment, CAST(count(DISTINCT r.Store) AS BIGINT) AS stores,
    avg(Sales) FILTER (WHERE DayOfWeek <= 5) AS mean_weekday_sales,
    avg(Sales) FILTER (WHERE DayOfWeek = 6) AS mean_saturday_sales,
    avg(Sales) FILTER (WHERE DayOfWeek = 7) AS mean_sunday_sales,
    100.0E0 * (avg(Sales) FILTER (WHERE DayOfWeek = 6) / avg(Sales) FILTER (WHERE DayOfWeek <= 5) - 1)
      AS sat_vs_weekday_pct
  FROM R r JOIN seg s ON s.Store = r.Store WHERE Open = 1 GROUP BY Segment""",
                              ["mean_weekday_sales", "mean_saturday_sales", "mean_sunday_sales",
                               "sat_vs_weekday_pct"], base=with_raw, extra=SEG)
    q["q08_ratio"] = final("""
  SELECT r.Segment, b.n, b.q1, b.median, b.q3,
    min(ratio) FILTER (WHERE ratio >= b.q1 - 1.5 * (b.q3 - b.q1) AND ratio <= b.q3 + 1.5 * (b.q3 - b.q1)) AS whisker_low,
    max(ratio) FILTER (WHERE ratio >= b.q1 - 1.5 * (b.q3 - b.q1) AND ratio <= b.q3 + 1.5 * (b.q3 - b.q1)) AS whisker_high,
    CAST(count(*) FILTER (WHERE NOT (ratio >= b.q1 - 1.5 * (b.q3 - b.q1) AND ratio <= b.q3 + 1.5 * (b.q3 - b.q1)))
      AS BIGINT) AS fliers
  FROM ratio r JOIN (SELECT Segment, CAST(count(*) AS BIGINT) AS n, quantile_cont(ratio, 0.25) AS q1,
                            quantile_cont(ratio, 0.5) AS median, quantile_cont(ratio, 0.75) AS q3
                     FROM ratio GROUP BY Segment) b ON b.Segment = r.Segment
  GROUP BY r.Segment, b.n, b.q1, b.median, b.q3""",
                           ["q1", "median", "q3", "whisker_low", "whisker_high"], base=with_raw, extra=SEG)
    z = ("((GREATEST(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / "
         "NULLIF(sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))), 0))")
    q["q08_mann_whitney"] = final(f"""
  SELECT u1 AS u_statistic, CASE WHEN {z} IS NOT NULL THEN LEAST({erfc_sql(z + ' / sqrt(2.0E0)')}, 1.0E0) END AS p_value,
    CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2
  FROM (SELECT sum(rk) FILTER (WHERE Segment = 'Opens all weekdays') - n1 * (n1 + 1) / 2 AS u1, n1, n2, tie
        FROM (SELECT *, {_rank('ratio')} AS rk FROM ratio),
             (SELECT CAST(count(*) FILTER (WHERE Segment = 'Opens all weekdays') AS DOUBLE) AS n1,
                     CAST(count(*) FILTER (WHERE Segment = 'Has weekday closures') AS DOUBLE) AS n2 FROM ratio),
             (SELECT sum(pow(t, 3) - t) AS tie FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM ratio GROUP BY ratio))
        GROUP BY n1, n2, tie)""", ["u_statistic", "p_value"], base=with_raw, extra=SEG)
    q["q09_assortment"] = final("""
  SELECT Assortment, CAST(count(DISTINCT Store) AS BIGINT) AS stores, avg(Sales) AS mean_sales,
    quantile_cont(Sales, 0.5) AS median_sales, avg(Customers) AS mean_customers,
    avg(Sales) / avg(Customers) AS sales_per_customer FROM T GROUP BY Assortment""",
                                ["mean_sales", "median_sales", "mean_customers", "sales_per_customer"])
    q["q09_cross"] = final("""
  SELECT StoreType, Assortment, avg(Sales) AS mean_sales, CAST(count(DISTINCT Store) AS BIGINT) AS stores
  FROM T GROUP BY 1, 2""", ["mean_sales"])
    band = """CASE WHEN CompetitionDistance > 0 AND CompetitionDistance <= 250 THEN '<250m'
      WHEN CompetitionDistance > 250 AND CompetitionDistance <= 500 THEN '250-500m'
      WHEN CompetitionDistance > 500 AND CompetitionDistance <= 1000 THEN '500m-1km'
      WHEN CompetitionDistance > 1000 AND CompetitionDistance <= 2500 THEN '1-2.5km'
      WHEN CompetitionDistance > 2500 AND CompetitionDistance <= 5000 THEN '2.5-5km'
      WHEN CompetitionDistance > 5000 AND CompetitionDistance <= 10000 THEN '5-10km'
      WHEN CompetitionDistance > 10000 THEN '>10km' END"""
    border = """CAST(CASE WHEN CompetitionDistance > 0 AND CompetitionDistance <= 250 THEN 0
      WHEN CompetitionDistance > 250 AND CompetitionDistance <= 500 THEN 1
      WHEN CompetitionDistance > 500 AND CompetitionDistance <= 1000 THEN 2
      WHEN CompetitionDistance > 1000 AND CompetitionDistance <= 2500 THEN 3
      WHEN CompetitionDistance > 2500 AND CompetitionDistance <= 5000 THEN 4
      WHEN CompetitionDistance > 5000 AND CompetitionDistance <= 10000 THEN 5
      WHEN CompetitionDistance > 10000 THEN 6 END AS INTEGER)"""
    q["q10_bands"] = final(f"""
  SELECT DistanceBand, band_order, CAST(count(DISTINCT Store) AS BIGINT) AS stores, avg(Sales) AS mean_sales,
    avg(Customers) AS mean_customers, avg(Sales) / avg(Customers) AS sales_per_customer
  FROM (SELECT *, {band} AS DistanceBand, {border} AS band_order FROM T WHERE HasCompetition = 1)
  WHERE DistanceBand IS NOT NULL GROUP BY 1, 2""", ["mean_sales", "mean_customers", "sales_per_customer"])
    q["q10_spearman"] = final(f"""
  SELECT scope, corr(rx, ry) AS spearman, CAST(count(*) AS BIGINT) AS stores
  FROM (SELECT scope, {_rank('distance', 'scope')} AS rx, {_rank('mean_sales', 'scope')} AS ry FROM (
          SELECT 'all' AS scope, * FROM stl
          UNION ALL SELECT CASE WHEN distance <= 500 THEN 'le_500' ELSE 'gt_500' END, * FROM stl))
  GROUP BY scope""", ["spearman"], extra="""
, stl AS (SELECT Store, avg(Sales) AS mean_sales, min(CompetitionDistance) AS distance
         FROM T WHERE HasCompetition = 1 GROUP BY Store)""")
    labels = ["-90 to -60", "-60 to -30", "-30 to 0", "0 to 30", "30 to 60", "60 to 90"]
    edges = [-90, -60, -30, 0, 30, 60, 90]
    bcase = "CASE " + " ".join(
        f"WHEN DaysSinceCompetitor > {lo} AND DaysSinceCompetitor <= {hi} THEN '{lab}'"
        for lo, hi, lab in zip(edges[:-1], edges[1:], labels)) + " END"
    ocase = "CAST(CASE " + " ".join(
        f"WHEN DaysSinceCompetitor > {lo} AND DaysSinceCompetitor <= {hi} THEN {i}"
        for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))) + " END AS INTEGER)"
    q["q11_buckets"] = final(f"""
  SELECT Bucket, bucket_order, CAST(count(DISTINCT Store) AS BIGINT) AS stores,
    avg(RelSales) AS mean_relative_sales, avg(Sales) AS mean_sales
  FROM (SELECT *, {bcase} AS Bucket, {ocase} AS bucket_order FROM ev) WHERE Bucket IS NOT NULL GROUP BY 1, 2""",
                             ["mean_relative_sales", "mean_sales"], extra=EVENTS)
    q["q11_curve"] = final("""
  SELECT DaysSinceCompetitor, mean_relative_sales,
    CASE WHEN count(mean_relative_sales) OVER w >= 5 THEN avg(mean_relative_sales) OVER w END AS smoothed
  FROM (SELECT DaysSinceCompetitor, avg(RelSales) AS mean_relative_sales FROM ev GROUP BY 1)
  WINDOW w AS (ORDER BY DaysSinceCompetitor ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)""",
                           ["mean_relative_sales", "smoothed"], extra=EVENTS)
    q["q12_variance"] = final("""
  SELECT sum(n * pow(store_mean - g, 2)) / sum(n) / min(tot) AS share_between, min(g) AS grand_mean,
    min(store_mean) AS min_store_mean, max(store_mean) AS max_store_mean
  FROM (SELECT Store, avg(Sales) AS store_mean, count(*) AS n FROM T GROUP BY Store),
       (SELECT avg(Sales) AS g, var_pop(Sales) AS tot FROM T)""",
                              ["share_between", "grand_mean", "min_store_mean", "max_store_mean"])
    q["q12_by_type"] = final("""
  SELECT StoreType, CAST(count(DISTINCT Store) AS BIGINT) AS stores, avg(Sales) AS mean_sales,
    stddev_samp(Sales) AS std_sales, avg(Customers) AS mean_customers, stddev_samp(Sales) / avg(Sales) AS cv
  FROM T GROUP BY StoreType""", ["mean_sales", "std_sales", "mean_customers", "cv"])
    q["q12_hist"] = final(_hist("sm", "store_mean", 50), ["lo", "hi"],
                          extra=", sm AS (SELECT Store, avg(Sales) AS store_mean FROM T GROUP BY Store)")
    q["q13_active"] = final("""
  SELECT *, 100.0E0 * (mean_sales / max(CASE WHEN IsPromo2Active = 0 THEN mean_sales END) OVER () - 1)
    AS lift_vs_dormant_pct
  FROM (SELECT IsPromo2Active, avg(Sales) AS mean_sales, avg(Customers) AS mean_customers,
          CAST(count(*) AS BIGINT) AS days FROM T WHERE Promo2 = 1 GROUP BY 1)""",
                            ["mean_sales", "mean_customers", "lift_vs_dormant_pct"])
    q["q13_participation"] = final("""
  SELECT *, 100.0E0 * (mean_sales / max(CASE WHEN Promo2 = 0 THEN mean_sales END) OVER () - 1)
    AS gap_vs_non_participants_pct
  FROM (SELECT Promo2, avg(Sales) AS mean_sales, CAST(count(*) AS BIGINT) AS days FROM T GROUP BY 1)""",
                                   ["mean_sales", "gap_vs_non_participants_pct"])

    def issue(src, order, name, cond):
        return (f"SELECT {order} AS issue_order, '{name}' AS issue, "
                f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS count, "
                f"100.0E0 * avg(CASE WHEN {cond} THEN 1 ELSE 0 END) AS pct FROM {src}")
    q["q14_quality"] = final("\n  UNION ALL ".join([
        issue("R", 1, "Closed store-days (Open=0)", "Open = 0"),
        issue("R", 2, "Open but zero sales", "Open = 1 AND Sales = 0"),
        issue("E", 3, "Missing Open in test", "Open IS NULL"),
        issue("R", 4, "Missing CompetitionDistance", "CompetitionDistance IS NULL"),
        issue("R", 5, "Missing CompetitionOpenSince*", "CompetitionOpenSinceYear IS NULL"),
        issue("R", 6, "Missing Promo2Since* / PromoInterval", "PromoInterval IS NULL"),
    ]), ["pct"], base=with_raw)
    q["q14_skew"] = final("""
  SELECT quantile_cont(Sales, 0.5) AS median_sales, skewness(Sales) AS skew, CAST(count(*) AS BIGINT) AS n
  FROM R WHERE Open = 1""", ["median_sales", "skew"], base=with_raw)
    q["q14_hist"] = final(_hist("(SELECT Sales FROM R WHERE Open = 1)", "Sales", 80), ["lo", "hi"], base=with_raw)
    return q
