"""Independent SQL (DuckDB dialect) for the correctness gate.

Each query key of the catalogue has a SQL twin here that rebuilds the
derived panel from the raw test tables (supplier, nation, lineitem,
orders, customer) and computes the same evidence table. Doubles are
rounded to 6 decimals on both sides; counts are BIGINT on both sides.
"""

from __future__ import annotations

from dateutil.easter import easter

# --- shared CTEs -----------------------------------------------------------

SPAN = """
span AS (SELECT min(CAST(l_shipdate AS DATE)) AS s, max(CAST(l_shipdate AS DATE)) AS e FROM lineitem)"""

_DAYNO = "date_diff('day', (SELECT s FROM span), {d})"

#: Easter Sundays, from a library rather than from the rule under test.
EASTER = "(VALUES " + ", ".join(f"({y}, DATE '{easter(y)}')" for y in range(1900, 2100)) + ") AS easter(y, sunday)"

STORE_DIM = """
store_dim AS (
  SELECT CAST(s_suppkey AS INTEGER) AS Store,
    CASE s_suppkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE 'd' END AS StoreType,
    CASE s_suppkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS Assortment,
    CASE WHEN s_suppkey % 10 <> 3 THEN CAST(70 + (s_suppkey * 7919) % 20000 AS DOUBLE) END AS CompetitionDistance,
    CAST(CASE WHEN s_suppkey % 3 <> 0 THEN 1 + s_suppkey % 12 END AS INTEGER) AS CompetitionOpenSinceMonth,
    CAST(CASE WHEN s_suppkey % 3 <> 0 THEN 1995 + s_suppkey % 7 END AS INTEGER) AS CompetitionOpenSinceYear,
    CAST(s_suppkey % 2 AS INTEGER) AS Promo2,
    CAST(CASE WHEN s_suppkey % 2 = 1 THEN 1 + (s_suppkey * 13) % 50 END AS INTEGER) AS Promo2SinceWeek,
    CAST(CASE WHEN s_suppkey % 2 = 1 THEN 1995 + s_suppkey % 5 END AS INTEGER) AS Promo2SinceYear,
    CASE s_suppkey % 6 WHEN 1 THEN 'Jan,Apr,Jul,Oct' WHEN 3 THEN 'Feb,May,Aug,Nov'
                       WHEN 5 THEN 'Mar,Jun,Sept,Dec' END AS PromoInterval,
    n_name AS State
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

FACTS = """
facts AS (
  SELECT CAST(l_suppkey AS INTEGER) AS Store, CAST(l_shipdate AS DATE) AS Date,
    SUM(CAST(ROUND(l_extendedprice * (1 - l_discount)) AS BIGINT)) AS Sales,
    COUNT(DISTINCT o_custkey) AS Customers
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2)"""

_SH = """CASE WHEN (month({d}) = 1 AND day({d}) = 1) OR (month({d}) = 5 AND day({d}) = 1)
                  OR (month({d}) = 10 AND day({d}) = 3) THEN 'a'
             WHEN date_diff('day', (SELECT sunday FROM """ + EASTER + """ WHERE y = year({d})), {d}) IN (-2, 1) THEN 'b'
             WHEN month({d}) = 12 AND day({d}) IN (25, 26) THEN 'c' ELSE '0' END"""

DAILY = """
spine AS (
  SELECT Store, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS Date
  FROM store_dim, span),
daily AS (
  SELECT s.Store, CAST(isodow(s.Date) AS INTEGER) AS DayOfWeek, s.Date,
    CAST(COALESCE(f.Sales, 0) AS BIGINT) AS Sales, CAST(COALESCE(f.Customers, 0) AS BIGINT) AS Customers,
    CAST(CASE WHEN f.Store IS NOT NULL OR (s.Store + """ + _DAYNO.format(d="s.Date") + """) % 97 = 0
              THEN 1 ELSE 0 END AS INTEGER) AS Open,
    CAST(CASE WHEN isodow(s.Date) <= 5 AND week(s.Date) % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS Promo,
    """ + _SH.format(d="s.Date") + """ AS StateHoliday,
    CAST(CASE WHEN month(s.Date) IN (7, 8) THEN 1 ELSE 0 END AS INTEGER) AS SchoolHoliday
  FROM spine s LEFT JOIN facts f ON f.Store = s.Store AND f.Date = s.Date)"""

FUTURE = """
future AS (
  SELECT CAST(Store AS BIGINT) * 1000 + """ + _DAYNO.format(d="Date") + """ AS Id, Store,
    CAST(isodow(Date) AS INTEGER) AS DayOfWeek, Date,
    CASE WHEN (Store + """ + _DAYNO.format(d="Date") + """) % 97 = 5 THEN NULL
         WHEN isodow(Date) = 7 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS Open,
    CAST(CASE WHEN isodow(Date) <= 5 AND week(Date) % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS Promo,
    CASE WHEN Date = (SELECT e FROM span) + 15 THEN 'a' ELSE '0' END AS StateHoliday,
    CAST(CASE WHEN month(Date) = 8 THEN 1 ELSE 0 END AS INTEGER) AS SchoolHoliday
  FROM (SELECT Store, CAST(unnest(generate_series(e + 1, e + 48, INTERVAL 1 DAY)) AS DATE) AS Date
        FROM store_dim, span))"""

EXTERNAL = """
obs AS (
  SELECT n_name, CAST(o_orderdate AS DATE) AS d, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
weather AS (
  SELECT n_name AS StateName, d AS Date,
    CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (COUNT(*) * 1000000.0E0) AS Mean_TemperatureC,
    CASE WHEN COUNT(*) > 1 THEN CAST(COUNT(*) AS DOUBLE) END AS Precipitationmm
  FROM obs GROUP BY 1, 2),
trend_state AS (
  SELECT n_name AS State, d - CAST(dayofweek(d) AS INTEGER) AS WeekStart, CAST(COUNT(*) AS INTEGER) AS TrendState
  FROM obs GROUP BY 1, 2),
trend_nat AS (
  SELECT d - CAST(dayofweek(d) AS INTEGER) AS WeekStart, CAST(COUNT(*) AS INTEGER) AS TrendDE
  FROM obs GROUP BY 1)"""

RAW = """
R AS (
  SELECT d.*, sd.StoreType, sd.Assortment, sd.CompetitionDistance, sd.CompetitionOpenSinceMonth,
    sd.CompetitionOpenSinceYear, sd.Promo2, sd.Promo2SinceWeek, sd.Promo2SinceYear, sd.PromoInterval,
    sd.State, w.Mean_TemperatureC, w.Precipitationmm, ts.TrendState, tn.TrendDE
  FROM daily d LEFT JOIN store_dim sd ON sd.Store = d.Store
  LEFT JOIN weather w ON w.StateName = sd.State AND w.Date = d.Date
  LEFT JOIN trend_state ts ON ts.State = sd.State AND ts.WeekStart = d.Date - CAST(dayofweek(d.Date) AS INTEGER)
  LEFT JOIN trend_nat tn ON tn.WeekStart = d.Date - CAST(dayofweek(d.Date) AS INTEGER)),
E AS (
  SELECT f.*, sd.StoreType, sd.Assortment, sd.CompetitionDistance, sd.CompetitionOpenSinceMonth,
    sd.CompetitionOpenSinceYear, sd.Promo2, sd.Promo2SinceWeek, sd.Promo2SinceYear, sd.PromoInterval, sd.State
  FROM future f LEFT JOIN store_dim sd ON sd.Store = f.Store)"""

_FF = """COALESCE(last_value({c} IGNORE NULLS) OVER (PARTITION BY Store ORDER BY Date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               first_value({c} IGNORE NULLS) OVER (PARTITION BY Store ORDER BY Date
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

GAP_COLS = ["Mean_TemperatureC", "Precipitationmm", "TrendState", "TrendDE"]

CLEAN = """
C1 AS (
  SELECT Store, DayOfWeek, Date, Sales, Customers, CAST(COALESCE(Open, 1) AS INTEGER) AS Open, Promo,
    COALESCE(StateHoliday, '0') AS StateHoliday, SchoolHoliday, StoreType, Assortment,
    COALESCE(CompetitionDistance, 200000.0::DOUBLE) AS CompetitionDistance,
    CAST(CASE WHEN CompetitionDistance IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS HasCompetition,
    COALESCE(CompetitionOpenSinceMonth, 0) AS CompetitionOpenSinceMonth,
    COALESCE(CompetitionOpenSinceYear, 0) AS CompetitionOpenSinceYear, Promo2,
    COALESCE(Promo2SinceWeek, 0) AS Promo2SinceWeek, COALESCE(Promo2SinceYear, 0) AS Promo2SinceYear,
    COALESCE(PromoInterval, 'None') AS PromoInterval, State,
    """ + ",\n    ".join(_FF.format(c=c) + f" AS {c}" for c in GAP_COLS) + """
  FROM R),
C2 AS (
  SELECT * REPLACE (""" + ", ".join(
    f"CAST(COALESCE({c}, (SELECT median({c}) FROM C1)) AS DOUBLE) AS {c}" for c in GAP_COLS) + """)
  FROM C1),
P AS (SELECT * FROM C2 WHERE Open = 1 AND Sales >= 1),
fence AS (
  SELECT Store, GREATEST(q1 - 3.0E0 * (q3 - q1), 0.0E0) AS lower, q3 + 3.0E0 * (q3 - q1) AS upper
  FROM (SELECT Store, quantile_cont(Sales, 0.25) AS q1, quantile_cont(Sales, 0.75) AS q3
        FROM P WHERE Open = 1 GROUP BY Store)),
C AS (
  SELECT P.*, CAST(CASE WHEN P.Open = 1 AND (P.Sales < f.lower OR P.Sales > f.upper) THEN 1 ELSE 0 END AS INTEGER)
    AS IsSalesOutlier
  FROM P LEFT JOIN fence f ON f.Store = P.Store)"""

_2PI = "6.283185307179586E0"

FEATURES = """
cal AS (
  SELECT DISTINCT Date AS H FROM (SELECT Date, StateHoliday FROM R UNION ALL SELECT Date, StateHoliday FROM E)
  WHERE COALESCE(StateHoliday, '0') <> '0'),
hd AS (
  SELECT dd.Date,
    CAST(LEAST(COALESCE(date_diff('day', dd.Date, min(CASE WHEN c.H >= dd.Date THEN c.H END)), 999), 999) AS INTEGER)
      AS DaysToNextHoliday,
    CAST(LEAST(COALESCE(date_diff('day', max(CASE WHEN c.H < dd.Date THEN c.H END), dd.Date), 999), 999) AS INTEGER)
      AS DaysAfterLastHoliday
  FROM (SELECT DISTINCT Date FROM C) dd CROSS JOIN cal c GROUP BY dd.Date),
F1 AS (
  SELECT C.*, CAST(year(C.Date) AS INTEGER) AS Year, CAST(month(C.Date) AS INTEGER) AS Month,
    CAST(day(C.Date) AS INTEGER) AS Day, CAST(week(C.Date) AS INTEGER) AS WeekOfYear,
    CAST(dayofyear(C.Date) AS INTEGER) AS DayOfYear, CAST(quarter(C.Date) AS INTEGER) AS Quarter,
    CAST(day(last_day(C.Date)) AS INTEGER) AS DaysInMonth,
    CAST(date_diff('day', (SELECT s FROM span), C.Date) AS INTEGER) AS TimeIndex,
    CAST(date_diff('day', C.Date, make_date(year(C.Date), 12, 25)) AS INTEGER) AS DaysToChristmas,
    hd.DaysToNextHoliday, hd.DaysAfterLastHoliday,
    CASE WHEN C.Promo2SinceYear > 0 THEN make_date(C.Promo2SinceYear, 1, 1)
         + CAST((8 - isodow(make_date(C.Promo2SinceYear, 1, 1))) % 7 AS INTEGER)
         + 7 * (C.Promo2SinceWeek - 1) END AS p2start
  FROM C LEFT JOIN hd ON hd.Date = C.Date),
F2 AS (
  SELECT *,
    CAST(CASE WHEN DayOfWeek >= 6 THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend,
    CAST(CASE WHEN DayOfWeek = 7 THEN 1 ELSE 0 END AS INTEGER) AS IsSunday,
    CAST(CASE WHEN Day <= 10 THEN 1 ELSE 0 END AS INTEGER) AS IsMonthStart,
    CAST(CASE WHEN Day > 10 AND Day <= 20 THEN 1 ELSE 0 END AS INTEGER) AS IsMidMonth,
    CAST(CASE WHEN Day > 20 THEN 1 ELSE 0 END AS INTEGER) AS IsMonthEnd,
    CAST(CASE WHEN Day <= 10 THEN 0 WHEN Day <= 20 THEN 1 ELSE 2 END AS INTEGER) AS MonthPhase,
    CAST(DaysInMonth - Day AS INTEGER) AS DaysToMonthEnd,
    CAST(CASE WHEN DaysInMonth - Day <= 3 OR Day <= 3 THEN 1 ELSE 0 END AS INTEGER) AS IsPayWeek,
    sin(""" + _2PI + """ * Month / 12.0E0) AS MonthSin, cos(""" + _2PI + """ * Month / 12.0E0) AS MonthCos,
    sin(""" + _2PI + """ * DayOfWeek / 7.0E0) AS DayOfWeekSin, cos(""" + _2PI + """ * DayOfWeek / 7.0E0) AS DayOfWeekCos,
    sin(""" + _2PI + """ * DayOfYear / 365.25E0) AS DayOfYearSin, cos(""" + _2PI + """ * DayOfYear / 365.25E0) AS DayOfYearCos,
    CAST(CASE WHEN Month = 12 THEN 1 ELSE 0 END AS INTEGER) AS IsDecember,
    CAST(CASE WHEN DaysToChristmas BETWEEN 0 AND 21 THEN 1 ELSE 0 END AS INTEGER) AS IsChristmasRunUp,
    CAST(CASE WHEN StateHoliday <> '0' THEN 1 ELSE 0 END AS INTEGER) AS IsStateHoliday,
    CAST(CASE WHEN DaysToNextHoliday <= 3 OR DaysAfterLastHoliday <= 3 THEN 1 ELSE 0 END AS INTEGER) AS IsHolidayWeek,
    CAST(CASE WHEN DaysToNextHoliday = 1 THEN 1 ELSE 0 END AS INTEGER) AS IsDayBeforeHoliday,
    CAST(CASE WHEN DaysAfterLastHoliday = 1 THEN 1 ELSE 0 END AS INTEGER) AS IsDayAfterHoliday,
    12 * (Year - CompetitionOpenSinceYear) + (Month - CompetitionOpenSinceMonth) AS months_open,
    CASE WHEN Promo2 = 1 AND PromoInterval NOT IN ('None', 'nan', '')
              AND list_contains(string_split(PromoInterval, ','),
                  ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sept','Oct','Nov','Dec'][Month])
              AND COALESCE(Date >= p2start, false) THEN 1 ELSE 0 END AS p2active
  FROM F1),
F3 AS (
  SELECT * EXCLUDE (months_open, p2active, p2start),
    CAST(CASE WHEN CompetitionOpenSinceYear > 0 THEN GREATEST(months_open, 0) ELSE 0 END AS INTEGER) AS CompetitionOpenMonths,
    CAST(CASE WHEN CompetitionOpenSinceYear > 0 AND months_open BETWEEN 0 AND 6 THEN 1 ELSE 0 END AS INTEGER) AS CompetitionIsNew,
    CAST(CASE WHEN CompetitionOpenSinceYear > 0 AND months_open < 0 THEN 1 ELSE 0 END AS INTEGER) AS CompetitionNotYetOpen,
    ln(1 + CompetitionDistance) AS CompetitionDistanceLog,
    CAST(CASE WHEN CompetitionDistance <= 500 THEN 1 ELSE 0 END AS INTEGER) AS IsCityCentre,
    CAST(p2active AS INTEGER) AS IsPromo2Active,
    CASE WHEN Promo2 = 1 THEN GREATEST(COALESCE(date_diff('day', p2start, Date) / 7.0E0, 0.0E0), 0.0E0)
         ELSE 0.0E0 END AS Promo2ActiveWeeks,
    CAST(CASE WHEN Promo = 1 AND p2active = 1 THEN 1 ELSE 0 END AS INTEGER) AS PromoAndPromo2,
    CAST(CASE WHEN Promo = 1 OR p2active = 1 THEN 1 ELSE 0 END AS INTEGER) AS AnyPromo
  FROM F2),
fit_rows AS (SELECT * FROM F3 WHERE Open = 1 AND Sales > 0),
st AS (
  SELECT Store, avg(Sales) AS StoreMeanSales, median(Sales) AS StoreMedianSales,
    COALESCE(stddev_samp(Sales), 0.0E0) AS StoreStdSales, CAST(max(Sales) AS DOUBLE) AS StoreMaxSales,
    CAST(count(*) AS DOUBLE) AS StoreOpenDays, avg(Customers) AS StoreMeanCustomers,
    CAST(sum(Sales) AS DOUBLE) / GREATEST(sum(Customers), 1) AS StoreSalesPerCustomer
  FROM fit_rows GROUP BY Store),
sdow AS (SELECT Store, DayOfWeek, avg(Sales) AS StoreDowMeanSales FROM fit_rows GROUP BY 1, 2),
spro AS (SELECT Store, Promo, avg(Sales) AS StorePromoMeanSales FROM fit_rows GROUP BY 1, 2),
smon AS (SELECT Store, Month, avg(Sales) AS StoreMonthMeanSales FROM fit_rows GROUP BY 1, 2),
gm AS (SELECT avg(Sales) AS g FROM fit_rows),
T AS (
  SELECT F3.*, st.StoreMeanSales, st.StoreMedianSales, st.StoreStdSales, st.StoreMaxSales, st.StoreOpenDays,
    st.StoreMeanCustomers, st.StoreSalesPerCustomer,
    COALESCE(sdow.StoreDowMeanSales, gm.g) AS StoreDowMeanSales,
    COALESCE(spro.StorePromoMeanSales, gm.g) AS StorePromoMeanSales,
    COALESCE(smon.StoreMonthMeanSales, gm.g) AS StoreMonthMeanSales,
    COALESCE(COALESCE(sdow.StoreDowMeanSales, gm.g) / NULLIF(st.StoreMeanSales, 0), 1.0E0) AS DowSalesIndex,
    COALESCE(COALESCE(smon.StoreMonthMeanSales, gm.g) / NULLIF(st.StoreMeanSales, 0), 1.0E0) AS MonthSalesIndex
  FROM F3 LEFT JOIN st ON st.Store = F3.Store
  LEFT JOIN sdow ON sdow.Store = F3.Store AND sdow.DayOfWeek = F3.DayOfWeek
  LEFT JOIN spro ON spro.Store = F3.Store AND spro.Promo = F3.Promo
  LEFT JOIN smon ON smon.Store = F3.Store AND smon.Month = F3.Month
  CROSS JOIN gm)"""

BASE_RAW = "WITH " + ",".join([SPAN, STORE_DIM, FACTS, DAILY, FUTURE, EXTERNAL, RAW])
BASE_CLEAN = BASE_RAW + "," + CLEAN
BASE_T = BASE_CLEAN + "," + FEATURES


def with_raw(sql: str) -> str:
    return BASE_RAW + "\n" + sql


def with_clean(sql: str) -> str:
    return BASE_CLEAN + "\n" + sql


def with_t(sql: str) -> str:
    """Prefix ``sql`` (which may start with ``, name AS (...)`` extra CTEs)."""
    return BASE_T + "\n" + sql
