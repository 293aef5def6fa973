"""SQL twins (DuckDB dialect) of the operator-level catalogue queries."""

from __future__ import annotations

from shopcast.plans.oracle import GAP_COLS, with_clean, with_raw, with_t
from shopcast.plans.oracle_questions import erfc_sql, final

# Schema of the joined raw frame R (column, Spark simple type name).
R_SCHEMA = [("Store", "int"), ("DayOfWeek", "int"), ("Date", "date"), ("Sales", "bigint"),
            ("Customers", "bigint"), ("Open", "int"), ("Promo", "int"), ("StateHoliday", "string"),
            ("SchoolHoliday", "int"), ("StoreType", "string"), ("Assortment", "string"),
            ("CompetitionDistance", "double"), ("CompetitionOpenSinceMonth", "int"),
            ("CompetitionOpenSinceYear", "int"), ("Promo2", "int"), ("Promo2SinceWeek", "int"),
            ("Promo2SinceYear", "int"), ("PromoInterval", "string"), ("State", "string"),
            ("Mean_TemperatureC", "double"), ("Precipitationmm", "double"), ("TrendState", "int"),
            ("TrendDE", "int")]

DATE_COLS = ["Year", "Month", "Day", "WeekOfYear", "DayOfYear", "Quarter", "DayOfWeek", "IsWeekend", "IsSunday",
             "DaysInMonth", "IsMonthStart", "IsMidMonth", "IsMonthEnd", "MonthPhase", "DaysToMonthEnd",
             "IsPayWeek", "MonthSin", "MonthCos", "DayOfWeekSin", "DayOfWeekCos", "DayOfYearSin",
             "DayOfYearCos", "TimeIndex", "IsDecember", "DaysToChristmas", "IsChristmasRunUp"]
TRIG = ["MonthSin", "MonthCos", "DayOfWeekSin", "DayOfWeekCos", "DayOfYearSin", "DayOfYearCos"]
STAT_COLS = ["StoreMeanSales", "StoreMedianSales", "StoreStdSales", "StoreMaxSales", "StoreOpenDays",
             "StoreMeanCustomers", "StoreSalesPerCustomer"]

_FFB = """COALESCE(last_value({c} IGNORE NULLS) OVER (PARTITION BY Store ORDER BY Date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               first_value({c} IGNORE NULLS) OVER (PARTITION BY Store ORDER BY Date
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

SPLIT = """, cut AS (SELECT max(Date) - 42 AS cutoff FROM T),
tr AS (SELECT T.* FROM T, cut WHERE Date <= cutoff AND Open = 1 AND Sales > 0),
va AS (SELECT T.* FROM T, cut WHERE Date > cutoff),
tdow AS (SELECT Store, DayOfWeek, avg(Sales) AS m FROM tr GROUP BY 1, 2),
tg AS (SELECT avg(Sales) AS g FROM tr)"""

FUTURE_SCORED = """, ec AS (SELECT Id, Store, Date, DayOfWeek, CAST(COALESCE(Open, 1) AS INTEGER) AS Open FROM E),
gr AS (SELECT CAST(sum(Sales) AS DOUBLE) / GREATEST(sum(Customers), 1) AS ratio FROM fit_rows),
fs AS (
  SELECT ec.*, COALESCE(sdow.StoreDowMeanSales, gm.g) AS PredictedSales,
    COALESCE(st.StoreSalesPerCustomer, gr.ratio) AS ratio
  FROM ec LEFT JOIN sdow ON sdow.Store = ec.Store AND sdow.DayOfWeek = ec.DayOfWeek
  LEFT JOIN st ON st.Store = ec.Store CROSS JOIN gm CROSS JOIN gr),
fc AS (SELECT *, CAST(CASE WHEN ratio > 0 THEN round_even(PredictedSales / ratio, 0) END AS BIGINT) AS PredictedCustomers
       FROM fs)"""


def operator_sql() -> dict[str, str]:
    q = {}
    q["panel_join"] = final("""
  SELECT d.*, sd.* EXCLUDE (Store, State) FROM daily d LEFT JOIN store_dim sd ON sd.Store = d.Store""",
                            ["CompetitionDistance"], base=with_raw)
    q["state_lookup"] = final("SELECT Store, State, State AS StateName FROM store_dim", [], base=with_raw)
    q["weather_join"] = final("SELECT Store, Date, State, Mean_TemperatureC, Precipitationmm FROM R",
                              ["Mean_TemperatureC", "Precipitationmm"], base=with_raw)
    q["trend_week_join"] = final("""
  SELECT Store, Date, Date - CAST(dayofweek(Date) AS INTEGER) AS WeekStart, TrendState, TrendDE FROM R""",
                                 [], base=with_raw)
    q["trend_parse"] = final("""
  SELECT 'state' AS kind, State, WeekStart, TrendState AS trend FROM trend_state
  UNION ALL SELECT 'national', '', WeekStart, TrendDE FROM trend_nat""", [], base=with_raw)
    q["date_spine"] = final("""
  SELECT Store, Date, 0 AS IsHoliday, CAST(CASE WHEN isodow(Date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend,
    0 AS IsPromo, 0 AS SchoolHoliday
  FROM (SELECT sd.Store, CAST(unnest(generate_series(CAST(m.s AS TIMESTAMP), CAST(m.s + 41 AS TIMESTAMP),
                                                     INTERVAL 1 DAY)) AS DATE) AS Date
        FROM store_dim sd, (SELECT max(Date) + 1 AS s FROM daily) m)""", [], base=with_raw)
    nulls = " + ".join(f"(count(*) - count({c}))" for c, _ in R_SCHEMA)
    q["profile"] = final(f"""
  SELECT CAST(count(*) AS BIGINT) AS rows, {len(R_SCHEMA)} AS cols, CAST({nulls} AS BIGINT) AS nulls,
    min(Date) AS min_date, max(Date) AS max_date, CAST(count(DISTINCT Store) AS BIGINT) AS stores,
    CAST(count(DISTINCT StateHoliday) AS BIGINT) AS state_holiday_values,
    CAST(count(*) FILTER (WHERE Open = 0) AS BIGINT) AS closed_rows,
    CAST(count(*) FILTER (WHERE Sales = 0) AS BIGINT) AS zero_sales_rows,
    CAST(count(*) FILTER (WHERE Sales = 0 AND Open = 1) AS BIGINT) AS open_zero_sales_rows FROM R""",
                         [], base=with_raw)
    parts = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
        f"100.0E0 * (count(*) - count({c})) / count(*) AS pct, '{t}' AS dtype FROM R" for c, t in R_SCHEMA)
    q["missing_report"] = final(f"SELECT * FROM ({parts}) WHERE missing > 0", ["pct"], base=with_raw)
    q["outlier_report"] = final("""
  SELECT Store, avg(Sales) AS mean, stddev_samp(Sales) AS std, CAST(max(Sales) AS DOUBLE) AS max,
    (CAST(max(Sales) AS DOUBLE) - avg(Sales)) / NULLIF(stddev_samp(Sales), 0) AS max_zscore
  FROM T WHERE Open = 1 GROUP BY Store""", ["mean", "std", "max", "max_zscore"])
    req = """, req AS (
  SELECT 'store-' || CAST(Store AS VARCHAR) AS request_id, Store,
    CASE WHEN Open IS NULL THEN 'not-a-date' ELSE strftime(Date, '%Y-%m-%d') END AS Date FROM E
  UNION ALL
  SELECT 'type-' || StoreType, Store, CASE WHEN Open IS NULL THEN 'not-a-date' ELSE strftime(Date, '%Y-%m-%d') END FROM E),
g AS (SELECT request_id, count(*) AS n, count(*) FILTER (WHERE try_cast(Date AS DATE) IS NULL) AS bad
      FROM req GROUP BY 1
      UNION ALL SELECT 'state-' || n_name, 0, 0 FROM nation)"""
    q["forecast_requests"] = final("""
  SELECT r.request_id, r.Store, r.Date,
    CASE WHEN g.n > 400 THEN 'too_many_rows' WHEN try_cast(r.Date AS DATE) IS NULL THEN 'unparsable_date'
         WHEN r.Store NOT IN (SELECT Store FROM store_dim) THEN 'unknown_store' ELSE 'accepted' END AS verdict
  FROM (SELECT request_id, Date,
          CAST(CASE WHEN Store % 5 = 0 THEN Store + (SELECT max(Store) FROM req) ELSE Store END AS INTEGER) AS Store FROM req) r
  JOIN g ON g.request_id = r.request_id""", [], base=with_raw, extra=req)
    q["request_validation"] = final("""
  SELECT request_id, 'missing_date_column' AS rule, CAST(0 AS BIGINT) AS violations FROM g
  UNION ALL SELECT request_id, 'unparsable_date', CAST(bad AS BIGINT) FROM g
  UNION ALL SELECT request_id, 'empty_request', CAST(CASE WHEN n = 0 THEN 1 ELSE 0 END AS BIGINT) FROM g
  UNION ALL SELECT request_id, 'too_many_rows', CAST(CASE WHEN n > 400 THEN 1 ELSE 0 END AS BIGINT) FROM g""",
                                    [], base=with_raw, extra=req)
    q["clean_missing"] = final("SELECT * FROM C2", ["CompetitionDistance"] + GAP_COLS, base=with_clean)
    q["fill_forward_back"] = final("SELECT Store, Date, " + ", ".join(GAP_COLS) + " FROM C2", GAP_COLS,
                                   base=with_clean)
    ff = ", ff AS (SELECT Store, Date, " + ", ".join(_FFB.format(c=c) + f" AS {c}" for c in GAP_COLS) + " FROM R)"
    ff += ", firsts AS (SELECT Store, " + ", ".join(
        f"arg_min({c}, Date) FILTER (WHERE {c} IS NOT NULL) AS f_{c}" for c in GAP_COLS) + " FROM ff GROUP BY Store)"
    ff += ", nxt AS (SELECT Store, " + ", ".join(
        f"first_value(f_{c} IGNORE NULLS) OVER (ORDER BY Store ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
        f" AS n_{c}" for c in GAP_COLS) + " FROM firsts)"
    ff += ", f2 AS (SELECT ff.Store, ff.Date, " + ", ".join(
        f"COALESCE(ff.{c}, nxt.n_{c}) AS {c}" for c in GAP_COLS) + " FROM ff LEFT JOIN nxt ON nxt.Store = ff.Store)"
    q["fill_frame_scope"] = final("SELECT Store, Date, " + ", ".join(
        f"CAST(COALESCE({c}, (SELECT median({c}) FROM f2)) AS DOUBLE) AS {c}" for c in GAP_COLS) + " FROM f2",
        GAP_COLS, base=with_raw, extra=ff)
    q["trading_days"] = final("SELECT Store, Date, Sales, Customers FROM P", [], base=with_clean)
    q["chrono_split"] = final("""
  SELECT CASE WHEN Date <= cutoff THEN 'train' ELSE 'valid' END AS split, CAST(count(*) AS BIGINT) AS rows,
    min(Date) AS first_date, max(Date) AS last_date, CAST(count(DISTINCT Store) AS BIGINT) AS stores
  FROM P, (SELECT max(Date) - 42 AS cutoff FROM P) GROUP BY 1""", [], base=with_clean)
    q["store_sample"] = final("""
  SELECT Store, CAST(count(*) AS BIGINT) AS trading_days FROM P
  WHERE Store IN (SELECT Store FROM (SELECT DISTINCT Store FROM R)
                  ORDER BY ((CAST(Store AS BIGINT) + 42) * 2654435761) % 4294967296, Store LIMIT 60)
  GROUP BY Store""", [], base=with_clean)
    q["outlier_fence"] = final("""
  SELECT Store, q1, q3, GREATEST(q1 - 3.0E0 * (q3 - q1), 0.0E0) AS lower, q3 + 3.0E0 * (q3 - q1) AS upper
  FROM (SELECT Store, quantile_cont(Sales, 0.25) AS q1, quantile_cont(Sales, 0.75) AS q3
        FROM P WHERE Open = 1 GROUP BY Store)""", ["q1", "q3", "lower", "upper"], base=with_clean)
    q["outlier_flag"] = final("SELECT Store, Date, Sales, IsSalesOutlier FROM C", [], base=with_clean)
    q["outlier_cap"] = final("""
  SELECT C.Store, C.Date, CASE WHEN IsSalesOutlier = 1 THEN LEAST(GREATEST(CAST(C.Sales AS DOUBLE), f.lower), f.upper)
    ELSE CAST(C.Sales AS DOUBLE) END AS Sales, IsSalesOutlier
  FROM C LEFT JOIN fence f ON f.Store = C.Store""", ["Sales"], base=with_clean)
    q["outlier_remove"] = final("SELECT Store, Date, Sales FROM C WHERE IsSalesOutlier = 0", [], base=with_clean)
    q["date_features"] = final("SELECT Store, Date, " + ", ".join(DATE_COLS) + " FROM T", TRIG)
    q["holiday_calendar"] = final("SELECT H AS Date FROM cal", [])
    q["holiday_distance"] = final("""
  SELECT dd.Date,
    CAST(LEAST(COALESCE(date_diff('day', dd.Date, min(CASE WHEN c.H >= dd.Date THEN c.H END)), 999), 999) AS INTEGER)
      AS DaysToNextHoliday,
    CAST(LEAST(COALESCE(date_diff('day', max(CASE WHEN c.H < dd.Date THEN c.H END), dd.Date), 999), 999) AS INTEGER)
      AS DaysAfterLastHoliday
  FROM (SELECT DISTINCT Date FROM R) dd CROSS JOIN cal c GROUP BY dd.Date""", [])
    q["holiday_flags"] = final("""
  SELECT Store, Date, DaysToNextHoliday, DaysAfterLastHoliday, IsStateHoliday, IsHolidayWeek, IsDayBeforeHoliday,
    IsDayAfterHoliday FROM T""", [])
    q["competition_features"] = final("""
  SELECT Store, Date, CompetitionOpenMonths, CompetitionIsNew, CompetitionNotYetOpen, CompetitionDistanceLog,
    IsCityCentre FROM T""", ["CompetitionDistanceLog"])
    q["promo2_active"] = final("SELECT Store, Date, IsPromo2Active, Promo2ActiveWeeks, PromoAndPromo2, AnyPromo FROM T",
                               ["Promo2ActiveWeeks"])
    q["store_stats"] = final("SELECT * FROM st", STAT_COLS)
    q["store_dow_mean"] = final("SELECT * FROM sdow", ["StoreDowMeanSales"])
    q["store_promo_mean"] = final("SELECT * FROM spro", ["StorePromoMeanSales"])
    q["store_month_mean"] = final("SELECT * FROM smon", ["StoreMonthMeanSales"])
    q["store_aggregates_joined"] = final("""
  SELECT Store, Date, StoreDowMeanSales, StorePromoMeanSales, StoreMonthMeanSales, DowSalesIndex, MonthSalesIndex
  FROM T""", ["StoreDowMeanSales", "StorePromoMeanSales", "StoreMonthMeanSales", "DowSalesIndex", "MonthSalesIndex"])
    others = ", ".join(f"COALESCE({e}, {fb}) AS {n}" for n, e, fb in (
        ("StoreMeanSales", "avg(b.Sales)", "min(tg.g)"), ("StoreMedianSales", "median(b.Sales)", "min(tg.g)"),
        ("StoreMaxSales", "CAST(max(b.Sales) AS DOUBLE)", "min(tg.g)"), ("StoreMeanCustomers", "avg(b.Customers)", "min(mc.c)"),
        ("StoreSalesPerCustomer", "CAST(sum(b.Sales) AS DOUBLE) / GREATEST(sum(b.Customers), 1)", "min(gr1.ratio)"),
        ("StoreDowMeanSales", "avg(b.Sales) FILTER (b.DayOfWeek = a.DayOfWeek)", "min(tg.g)"),
        ("StorePromoMeanSales", "avg(b.Sales) FILTER (b.Promo = a.Promo)", "min(tg.g)"),
        ("StoreMonthMeanSales", "avg(b.Sales) FILTER (b.Month = a.Month)", "min(tg.g)")))
    q["store_leave_one_out"] = final("""
  SELECT *, COALESCE(StoreDowMeanSales / NULLIF(StoreMeanSales, 0), 1.0E0) AS DowSalesIndex,
    COALESCE(StoreMonthMeanSales / NULLIF(StoreMeanSales, 0), 1.0E0) AS MonthSalesIndex FROM loo""",
                                     STAT_COLS + ["StoreDowMeanSales", "StorePromoMeanSales", "StoreMonthMeanSales", "DowSalesIndex", "MonthSalesIndex"],
                                     extra=SPLIT + f""",
gr1 AS (SELECT CAST(sum(Sales) AS DOUBLE) / GREATEST(sum(Customers), 1) AS ratio, stddev_samp(Sales) AS sd FROM tr),
mc AS (SELECT median(c) AS c, median(n) AS n FROM (SELECT avg(Customers) AS c, CAST(count(*) AS DOUBLE) AS n FROM tr GROUP BY Store)),
loo AS (
  SELECT a.Store, a.Date, {others}, COALESCE(CAST(NULLIF(count(b.Date), 0) AS DOUBLE), min(mc.n)) AS StoreOpenDays,
    floor(CASE WHEN count(b.Date) = 0 THEN min(gr1.sd) ELSE COALESCE(stddev_samp(b.Sales), 0) END * 100.0E0 + 0.5E0) / 100.0E0 AS StoreStdSales
  FROM tr a LEFT JOIN tr b ON b.Store = a.Store AND b.Date <> a.Date CROSS JOIN tg CROSS JOIN gr1 CROSS JOIN mc
  GROUP BY a.Store, a.Date, a.DayOfWeek, a.Promo, a.Month)""")
    q["csv_rejects"] = final("""
  SELECT CASE r WHEN 7 THEN 'bad date in Date: 31.02.' WHEN 11 THEN 'bad bigint in Sales: n/a' WHEN 13 THEN 'bad bigint in Sales: 1e99'
      WHEN 17 THEN '2 cells for 9 columns' ELSE 'good' END AS reason,
    CASE WHEN r NOT IN (7, 11, 13, 17) THEN Store END AS Store, CASE WHEN r NOT IN (7, 11, 13, 17) THEN Date END AS Date,
    CASE WHEN r NOT IN (7, 11, 13, 17) THEN Sales END AS Sales,
    CASE r WHEN 17 THEN Store || ',' || Date WHEN 7 THEN Store || ',' || DayOfWeek || ',31.02.,' || Sales || rest
      WHEN 11 THEN Store || ',' || DayOfWeek || ',' || Date || ',n/a' || rest
      WHEN 13 THEN Store || ',' || DayOfWeek || ',' || Date || ',1e99' || rest END AS line
  FROM (SELECT *, ',' || Customers || ',' || Open || ',' || Promo || ',' || StateHoliday || ',' || SchoolHoliday AS rest,
          (date_diff('day', (SELECT s FROM span), Date) + Store) % 101 AS r FROM daily)""", [], base=with_raw)
    q["clustered_outliers"] = q["outlier_flag"]
    derived = ["Promo2ActiveWeeks", *STAT_COLS, "StoreDowMeanSales", "StorePromoMeanSales", "StoreMonthMeanSales", "DowSalesIndex", "MonthSalesIndex"]
    q["pipeline_features"] = final(f"""
  SELECT Store, Date, IsSalesOutlier, TimeIndex, DaysToNextHoliday, DaysAfterLastHoliday, CompetitionOpenMonths, {', '.join(derived)} FROM T""", derived)
    q["metrics_bundle"] = final("""
  SELECT sqrt(avg(CASE WHEN y <> 0 THEN pow((y - p) / y, 2) END)) AS rmspe, sqrt(avg(pow(y - p, 2))) AS rmse,
    avg(abs(y - p)) AS mae, avg(CASE WHEN y <> 0 THEN abs(y - p) / abs(y) END) AS mape,
    1 - sum(pow(y - p, 2)) / (count(y) * var_pop(y)) AS r2, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT CAST(va.Sales AS DOUBLE) AS y, COALESCE(tdow.m, tg.g) AS p
        FROM va LEFT JOIN tdow ON tdow.Store = va.Store AND tdow.DayOfWeek = va.DayOfWeek CROSS JOIN tg)""",
                                ["rmspe", "rmse", "mae", "mape", "r2"], extra=SPLIT)
    q["interval_coverage"] = final("""
  SELECT avg(CAST(va.Sales BETWEEN iv.lower AND iv.upper AS DOUBLE)) AS coverage,
    avg(iv.upper - iv.lower) AS mean_width, CAST(count(*) AS BIGINT) AS n
  FROM va LEFT JOIN (SELECT Store, DayOfWeek, quantile_cont(Sales, 0.025) AS lower,
                            quantile_cont(Sales, 0.975) AS upper FROM tr GROUP BY 1, 2) iv
    ON iv.Store = va.Store AND iv.DayOfWeek = va.DayOfWeek""", ["coverage", "mean_width"], extra=SPLIT)
    q["customers_estimate"] = final("SELECT Id, Store, Date, PredictedSales, PredictedCustomers FROM fc",
                                    ["PredictedSales"], extra=FUTURE_SCORED)
    q["closed_rule"] = final("""
  SELECT Id, Store, Date, Open, CASE WHEN Open = 0 THEN 0.0E0 ELSE PredictedSales END AS PredictedSales,
    CASE WHEN Open = 0 THEN CAST(0 AS BIGINT) ELSE PredictedCustomers END AS PredictedCustomers FROM fc""",
                             ["PredictedSales"], extra=FUTURE_SCORED)
    return q


SCALED = """, s0 AS (
  SELECT Store, Date, Sales AS value, row_number() OVER (PARTITION BY Store ORDER BY Date) - 1 AS pos,
    count(*) OVER (PARTITION BY Store) AS n FROM T WHERE Sales > 0),
s1 AS (
  SELECT *, CASE WHEN pos < n - 42 THEN 'train' ELSE 'valid' END AS split,
    min(CASE WHEN pos < n - 42 THEN value END) OVER (PARTITION BY Store) AS lo,
    max(CASE WHEN pos < n - 42 THEN value END) OVER (PARTITION BY Store) AS hi
  FROM s0 WHERE n >= 66),
s2 AS (SELECT *, COALESCE(NULLIF(CAST(hi - lo AS DOUBLE), 0), 1.0E0) AS rng FROM s1),
s3 AS (SELECT *, 2.0E0 * (value - lo) / rng - 1.0E0 AS scaled FROM s2)"""

NATIONAL = """, ns AS (SELECT Date, CAST(sum(Sales) AS BIGINT) AS value FROM T WHERE Sales > 0 GROUP BY Date),
x AS (SELECT row_number() OVER (ORDER BY Date) - 1 AS t, CAST(value AS DOUBLE) - avg(CAST(value AS DOUBLE)) OVER () AS d,
        count(*) OVER () AS n FROM ns)"""


#: Yule-Walker by the Durbin-Levinson recursion over lists.
PARTIAL = """, r0 AS (
  SELECT g.k, sum(a.d * b.d) / min(z.c0) AS acf, min(a.n) AS n
  FROM x a, (SELECT unnest(range(0, 22)) AS k) g, x b, (SELECT sum(d * d) AS c0 FROM x) z
  WHERE b.t = a.t + g.k GROUP BY g.k),
r1 AS (SELECT list(acf * n / (n - k) ORDER BY k) AS rho FROM r0),
dl AS (
  WITH RECURSIVE step(k, phi, v) AS (
    SELECT 0, CAST([] AS DOUBLE[]), 1.0E0
    UNION ALL
    SELECT k + 1, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - w * phi[k + 1 - i]), w), w FROM (
      SELECT k, phi, rho, (rho[k + 2] - COALESCE(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * rho[k + 2 - i])), 0.0E0))
        / (1.0E0 - COALESCE(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * rho[i + 1])), 0.0E0)) AS w
      FROM step, r1 WHERE k < 21))
  SELECT k, v FROM step),
partial AS (SELECT CAST(r0.k AS INTEGER) AS lag, r0.acf, dl.v AS pacf FROM r0 JOIN dl ON dl.k = r0.k)"""

ADF_OUT = "statistic, p_value, used_lag, nobs, is_stationary, crit_1pct, crit_5pct, crit_10pct"
ADF_DOUBLES = ["statistic", "p_value", "crit_1pct", "crit_5pct", "crit_10pct"]


def eliminated(name: str, start: str, m: str, steps: str) -> str:
    """CTE of Gaussian elimination over a flat list ``a`` of ``m`` x ``m``
    numbers per id, one row per step ``k``: columns id, k, a, m, steps."""
    return f""", {name} AS (
  WITH RECURSIVE e(id, k, a, m, steps) AS (
    SELECT id, 0, a, {m}, {steps} FROM {start}
    UNION ALL
    SELECT id, k + 1, list_transform(range(0, m * m), lambda i: a[i + 1] - a[(i // m) * m + k + 1] * a[k * m + i % m + 1] / NULLIF(a[k * m + k + 1], 0)),
      m, steps FROM e WHERE k < steps)
  SELECT * FROM e)"""


def moments(name: str, rows: str, order: str) -> str:
    """CTE of the flat cross moments of long rows (id, pos, c, v), columns ordered by ``order``."""
    return f""", {name} AS (
  SELECT id, list(s ORDER BY ci, cj) AS a FROM (
    SELECT a.id, {order.format(c='a.c')} AS ci, {order.format(c='b.c')} AS cj, sum(a.v * b.v) AS s
    FROM {rows} a JOIN {rows} b ON b.id = a.id AND b.pos = a.pos GROUP BY ALL) GROUP BY id)"""


def adf_ctes(series: str) -> str:
    """Augmented Dickey-Fuller of the (id, Date, value) rows: long rows of the
    regression's columns (0 constant, 1 level, 1 + j lagged differences, 1000
    target), their products by a join, elimination step by step."""
    z = """SELECT id, pos, 0 AS c, 1.0E0 AS v FROM {0} UNION ALL SELECT id, pos, 1, x1 FROM {0} UNION ALL SELECT id, pos, 1000, d FROM {0}
    UNION ALL SELECT t.id, t.pos, 1 + t.pos - u.pos, u.d FROM {0} t JOIN adf_d u ON u.id = t.id AND u.pos < t.pos AND u.pos >= t.pos - t.lags AND u.d IS NOT NULL"""
    stat = "xy / xx / sqrt((yy - xy * xy / xx) / (nobs - lags - 2) / xx)"
    poly = "CASE WHEN s <= -1.61E0 THEN (0.038269E0 * s + 1.4412E0) * s + 2.1659E0 ELSE ((-0.010368E0 * s - 0.12745E0) * s + 0.93202E0) * s + 1.7339E0 END"
    crit = ", ".join(f"(({d}E0 * (1.0E0 / nobs) + {c}E0) * (1.0E0 / nobs) + {b}E0) * (1.0E0 / nobs) + {a}E0 AS {n}" for n, (a, b, c, d) in (
        ("crit_1pct", (-3.43035, -6.5393, -16.786, -79.433)), ("crit_5pct", (-2.86154, -2.8903, -4.234, -40.04)),
        ("crit_10pct", (-2.56677, -1.5384, -2.809, 0.0))))
    return (f""", adf_s AS ({series}),
adf_x AS (
  SELECT id, CAST(value AS DOUBLE) - min(CAST(value AS DOUBLE)) OVER (PARTITION BY id) AS x, row_number() OVER (PARTITION BY id ORDER BY Date) - 1 AS pos,
    count(*) OVER (PARTITION BY id) AS n FROM adf_s),
adf_d AS (
  SELECT id, pos, n, lag(x) OVER (PARTITION BY id ORDER BY pos) AS x1, x - lag(x) OVER (PARTITION BY id ORDER BY pos) AS d,
    GREATEST(LEAST(n // 2 - 2, CAST(ceil(12.0E0 * pow(n / 100.0E0, 0.25E0)) AS BIGINT)), 0) AS lags
  FROM adf_x WHERE n >= 6),
adf_a AS (SELECT * FROM adf_d WHERE pos > lags),
adf_z AS MATERIALIZED ({z.format('adf_a')})"""
            + moments("adf_m", "adf_z", "{c}")
            + ", adf_m1 AS (SELECT m.id, m.a, l.lags, l.n FROM adf_m m JOIN (SELECT DISTINCT id, lags, n FROM adf_a) l ON l.id = m.id)"
            + eliminated("adf_e", "adf_m1", "lags + 3", "lags + 2")
            + f""",
adf_aic AS (
  SELECT e.id, e.k - 2 AS p, (n - 1 - lags) * (ln(2 * pi()) + ln(e.a[e.m * e.m] / (n - 1 - lags)) + 1.0E0) + 2 * e.k AS aic
  FROM adf_e e JOIN adf_m1 m ON m.id = e.id WHERE e.k >= 2),
adf_p AS (SELECT id, p FROM adf_aic QUALIFY row_number() OVER (PARTITION BY id ORDER BY aic, p) = 1),
adf_b AS (SELECT d.id, d.pos, d.n, d.x1, d.d, p.p AS lags FROM adf_d d JOIN adf_p p ON p.id = d.id WHERE d.pos > p.p),
adf_y AS MATERIALIZED ({z.format('adf_b')})"""
            + moments("adf_n", "adf_y", "CASE WHEN {c} = 1 THEN 999 ELSE {c} END")
            + ", adf_n1 AS (SELECT m.id, m.a, l.lags, l.n FROM adf_n m JOIN (SELECT DISTINCT id, lags, n FROM adf_b) l ON l.id = m.id)"
            + eliminated("adf_f", "adf_n1", "lags + 3", "lags + 1")
            + f""",
adf_t AS (
  SELECT f.id, lags, n - 1 - lags AS nobs, f.a[(m - 2) * m + m - 1] AS xx, f.a[(m - 2) * m + m] AS xy, f.a[m * m] AS yy
  FROM adf_f f JOIN adf_n1 n1 ON n1.id = f.id WHERE f.k = lags + 1),
adf_u AS (SELECT *, {stat} AS s FROM adf_t WHERE xx > 0 AND yy - xy * xy / xx > 0 AND nobs - lags - 2 > 0),
adf_v AS (SELECT *, {poly} AS g FROM adf_u),
adf_w AS (
  SELECT id, s AS statistic, lags, nobs, {crit}, CASE WHEN s > 2.74E0 THEN 1.0E0 WHEN s < -18.83E0 THEN 0.0E0
      WHEN g <= 0 THEN 0.5E0 * {erfc_sql('(-g / sqrt(2.0E0))')} ELSE 1.0E0 - 0.5E0 * {erfc_sql('(g / sqrt(2.0E0))')} END AS p_value
  FROM adf_v),
tested AS (
  SELECT id, statistic, p_value, CAST(lags AS INTEGER) AS used_lag, CAST(nobs AS INTEGER) AS nobs,
    CAST(CASE WHEN p_value < 0.05E0 THEN 1 ELSE 0 END AS INTEGER) AS is_stationary, crit_1pct, crit_5pct, crit_10pct FROM adf_w)""")


def series_sql() -> dict[str, str]:
    q = {}
    q["series_national"] = final("SELECT * FROM ns", [], extra=NATIONAL)
    q["series_diff"] = final("""
  SELECT Date, value, diff FROM (SELECT Date, value, value - lag(value) OVER (ORDER BY Date) AS diff FROM ns)
  WHERE diff IS NOT NULL""", [], extra=NATIONAL)
    q["acf"] = final("""
  SELECT CAST(g.k AS INTEGER) AS lag, sum(a.d * b.d) / min(z.c0) AS acf, CAST(min(a.n) AS BIGINT) AS n
  FROM x a, (SELECT unnest(range(0, 22)) AS k) g, x b, (SELECT sum(d * d) AS c0 FROM x) z
  WHERE b.t = a.t + g.k GROUP BY g.k""", ["acf"], extra=NATIONAL)
    q["pacf"] = final("SELECT lag, acf, pacf FROM partial", ["acf", "pacf"], extra=NATIONAL + PARTIAL)
    national = NATIONAL + adf_ctes("SELECT 1 AS id, Date, value FROM ns")
    q["adf_national"] = final(f"SELECT {ADF_OUT} FROM tested", ADF_DOUBLES, extra=national)
    stores = adf_ctes("SELECT Store AS id, Date, Sales AS value FROM T WHERE Sales > 0")
    q["adf_by_store"] = final(f"SELECT ids.id AS Store, {ADF_OUT} FROM (SELECT DISTINCT id FROM adf_s) ids LEFT JOIN tested ON tested.id = ids.id",
                              ADF_DOUBLES, extra=stores)
    q["series_diff_if_needed"] = final("""
  SELECT Store, Date, CASE WHEN st = 1 THEN v ELSE v - before END AS value_used, 1 - st AS differenced
  FROM (SELECT s.id AS Store, s.Date, CAST(s.value AS DOUBLE) AS v, COALESCE(t.is_stationary, 1) AS st,
          lag(CAST(s.value AS DOUBLE)) OVER (PARTITION BY s.id ORDER BY s.Date) AS before
        FROM adf_s s LEFT JOIN tested t ON t.id = s.id)
  WHERE st = 1 OR before IS NOT NULL""", ["value_used"], extra=stores)
    q["minmax_scaled"] = final("""
  SELECT Store, Date, split, scaled, (scaled + 1.0E0) / 2.0E0 * rng + lo AS inverse, lo, hi FROM s3""",
                               ["scaled", "inverse"], extra=SCALED)
    q["windows"] = final("""
  SELECT Store, Date, split, x, y, lo, hi FROM (
    SELECT Store, Date, split, pos, scaled AS y, lo, hi,
      list(scaled) OVER (PARTITION BY Store ORDER BY pos ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS x FROM s3)
  WHERE pos >= 14""", ["y"], extra=SCALED)
    return q
