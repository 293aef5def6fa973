"""Micro-frames with literal expected values, one per semantics trap."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shopcast.functions import stats
from shopcast.functions.calendar import date_feature_columns, week_start_sunday
from shopcast.functions.promo import competition_promo_columns, promo2_start
from shopcast.operators import clean as C
from shopcast.operators import features as FE
from shopcast.operators import forecast as FC
from shopcast.operators import metrics as M
from shopcast.operators import series as K


def D(s):
    return dt.date.fromisoformat(s)


def test_fill_store_and_frame_scope(spark):
    rows = [(1, D("2013-01-01"), None), (1, D("2013-01-02"), 1.0),
            (2, D("2013-01-01"), None), (2, D("2013-01-02"), None),
            (3, D("2013-01-01"), None), (3, D("2013-01-02"), 5.0)]
    df = spark.createDataFrame(rows, "Store int, Date date, Mean_TemperatureC double")
    frame = C.fill_forward_back(df, ["Mean_TemperatureC"], scope="frame")
    got = {(r.Store, r.Date): r.Mean_TemperatureC for r in frame.collect()}
    assert [got[(s, D(d))] for s in (1, 2, 3) for d in ("2013-01-01", "2013-01-02")] == [1, 1, 5, 5, 5, 5]
    store = C.fill_forward_back(df, ["Mean_TemperatureC"], scope="store")
    got = {(r.Store, r.Date): r.Mean_TemperatureC for r in store.collect()}
    m = 3.0  # median of [1, 1, 5, 5] after in-store fills
    assert [got[(s, D(d))] for s in (1, 2, 3) for d in ("2013-01-01", "2013-01-02")] == [1, 1, m, m, 5, 5]


def test_clean_is_idempotent(spark):
    df = spark.createDataFrame([(1, D("2013-01-01"), None)], "Store int, Date date, CompetitionDistance double")
    once = C.clean_missing(df)
    twice = C.clean_missing(once)
    assert once.first().HasCompetition == 0
    assert twice.first().HasCompetition == 0
    assert twice.first().CompetitionDistance == C.NO_COMPETITION_DISTANCE


def test_holiday_distance(spark):
    cal = spark.createDataFrame([(D("2013-01-01"),), (D("2013-03-29"),)], "Date date")
    dates = spark.createDataFrame([(D(x),) for x in ("2012-12-30", "2013-01-01", "2013-01-02", "2013-04-01")],
                                  "Date date")
    got = {r.Date.isoformat(): (r.DaysToNextHoliday, r.DaysAfterLastHoliday)
           for r in FE.holiday_distance(dates, cal).collect()}
    assert got == {"2012-12-30": (2, 999), "2013-01-01": (0, 999), "2013-01-02": (86, 1),
                   "2013-04-01": (999, 3)}
    empty = spark.createDataFrame([], "Date date")
    r = FE.holiday_distance(dates, empty).collect()
    assert all(x.DaysToNextHoliday == 999 and x.DaysAfterLastHoliday == 999 for x in r)


def test_calendar_functions(spark):
    df = spark.createDataFrame([(D("2015-07-31"),), (D("2013-12-30"),), (D("2014-06-01"),)], "Date date")
    cols = date_feature_columns(F.col("Date"))
    out = df.select("Date", cols["DayOfWeek"].alias("dow"), cols["WeekOfYear"].alias("wk"),
                    week_start_sunday(F.col("Date")).alias("ws")).collect()
    got = {r.Date.isoformat(): (r.dow, r.wk, r.ws.isoformat()) for r in out}
    assert got == {"2015-07-31": (5, 31, "2015-07-26"), "2013-12-30": (1, 1, "2013-12-29"),
                   "2014-06-01": (7, 22, "2014-06-01")}


def test_promo2_null_start_and_sept(spark):
    df = spark.createDataFrame(
        [(D("2015-09-10"), 2015, 9, 1, 0, 0, 0, 0, 0, 100.0, "None", 0),
         (D("2015-09-10"), 2015, 9, 1, 0, 0, 1, 2014, 10, 100.0, "Mar,Jun,Sept,Dec", 1)],
        "Date date, Year int, Month int, Promo int, CompetitionOpenSinceYear int, "
        "CompetitionOpenSinceMonth int, Promo2 int, Promo2SinceYear int, Promo2SinceWeek int, "
        "CompetitionDistance double, PromoInterval string, k int")
    cols = competition_promo_columns({c: F.col(c) for c in df.columns})
    r = df.select("k", promo2_start(F.col("Promo2SinceYear"), F.col("Promo2SinceWeek")).alias("s"),
                  cols["IsPromo2Active"].alias("a"), cols["Promo2ActiveWeeks"].alias("w")).orderBy("k").collect()
    assert r[0].s is None and r[0].a == 0 and r[0].w == 0.0
    assert r[1].a == 1  # "Sept" matches September
    assert r[1].s == D("2014-03-10")  # week 1 starts on the first Monday, 2014-01-06


def test_promo2_start_matches_strptime(spark):
    rows = [(y, w) for y in range(2008, 2017) for w in (1, 2, 13, 27, 52)]
    df = spark.createDataFrame(rows, "y int, w int")
    got = {(r.y, r.w): r.s for r in df.select("y", "w", promo2_start(F.col("y"), F.col("w")).alias("s")).collect()}
    for (y, w), s in got.items():
        assert s == dt.datetime.strptime(f"{y}{w:02d}1", "%Y%W%w").date()


def test_basket_zero_customers(spark):
    from shopcast.plans.questions import basket
    df = spark.createDataFrame([(10, 0), (10, 5)], "Sales long, Customers long")
    r = df.agg(F.avg(basket()).alias("b")).first()
    assert r.b == 2.0


def test_corrected_skew(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2.5, 9, 4]], "x double")
    r = df.agg(stats.corrected_skewness(F.col("x")).alias("g1"), F.skewness("x").alias("raw")).first()
    assert abs(r.g1 - 1.62732296830308) < 1e-9
    assert abs(r.raw - 1.0916414) < 1e-6


def test_right_closed_bins(spark):
    from shopcast.plans.questions import DISTANCE_EDGES, DISTANCE_LABELS, EVENT_LABELS
    df = spark.createDataFrame([(0.0,), (250.0,), (250.1,)], "x double")
    got = [r.b for r in df.select(stats.right_closed_bin(F.col("x"), DISTANCE_EDGES, DISTANCE_LABELS)
                                  .alias("b")).collect()]
    assert got == [None, "<250m", "250-500m"]
    ev = spark.createDataFrame([(-90,), (0,), (1,)], "x int")
    got = [r.b for r in ev.select(stats.right_closed_bin(F.col("x"), [-90, -60, -30, 0, 30, 60, 90], EVENT_LABELS)
                                  .alias("b")).collect()]
    assert got == [None, "-30 to 0", "0 to 30"]


def test_qcut_groups(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    e = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("e"))
    j = stats.with_scalars(df, e)
    got = [r.q for r in j.select("x", stats.qcut_index(F.col("x"), [F.col("e")[0], F.col("e")[1], F.col("e")[2]])
                                 .alias("q")).orderBy("x").collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 3, 3]


def test_centred_rolling_window(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(i, float(i * i)) for i in range(40)], "d int, v double")
    w = Window.orderBy("d").rowsBetween(-7, 6)
    r = {x.d: x.s for x in df.select("d", F.when(F.count("v").over(w) >= 5, F.avg("v").over(w)).alias("s"))
         .collect()}
    assert r[14] == sum(i * i for i in range(7, 21)) / 14
    assert r[0] == sum(i * i for i in range(0, 7)) / 7


def test_windows_counts_and_skip(spark):
    rows = [(1, D("2013-01-01") + dt.timedelta(days=i), float(i)) for i in range(120)]
    rows += [(2, D("2013-01-01") + dt.timedelta(days=i), float(i)) for i in range(65)]
    s = spark.createDataFrame(rows, "Store int, Date date, value double")
    w = K.windows(s, ["Store"], window=14, val_days=42)
    counts = {(r.Store, r.split): r.n for r in w.groupBy("Store", "split").agg(F.count("*").alias("n")).collect()}
    assert counts == {(1, "train"): 64, (1, "valid"): 42}
    first_val = w.filter((F.col("split") == "valid")).orderBy("Date").first()
    assert len(first_val.x) == 14


def test_constant_series_scaling(spark):
    rows = [(1, D("2013-01-01") + dt.timedelta(days=i), 7.0) for i in range(70)]
    s = spark.createDataFrame(rows, "Store int, Date date, value double")
    x = K.scaled_positions(s, ["Store"])
    r = x.select("scaled", K.inverse_scale(F.col("scaled"), F.col("lo"), F.col("hi")).alias("inv")).distinct().collect()
    assert [(a.scaled, a.inv) for a in r] == [(-1.0, 7.0)]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 5.0), (100.0, 90.0)], "y double, p double")
    r = M.evaluate(df, "y", "p").first()
    assert abs(r.rmspe - 0.1) < 1e-12 and abs(r.mape - 0.1) < 1e-12
    assert r.mae == 7.5 and abs(r.rmse - math.sqrt(62.5)) < 1e-12
    z = spark.createDataFrame([(0.0, 5.0)], "y double, p double")
    assert M.evaluate(z, "y", "p").first().rmspe is None


def test_request_validation(spark):
    ok = [("a", 1, "2015-08-01")]
    bad = [("b", 1, "not a date")]
    big = [("c", 1, "2015-08-01")] * 401
    req = spark.createDataFrame(ok + bad + big, "request_id string, Store int, Date string")
    got = {(r.request_id, r.rule): r.violations for r in FC.validate_requests(req).collect()}
    assert got[("b", "unparsable_date")] == 1 and got[("c", "too_many_rows")] == 1
    assert got[("a", "unparsable_date")] == 0
    nodate = spark.createDataFrame([("d", 1)], "request_id string, Store int")
    got = {r.rule: r.violations for r in FC.validate_requests(nodate).collect()}
    assert got["missing_date_column"] == 1
    empty = spark.createDataFrame([], "request_id string, Store int, Date string")
    assert FC.validate_requests(empty).count() == 0  # no request id, nothing to report


def test_unseen_store_fallbacks(spark):
    fit = spark.createDataFrame([(1, 1, 1, 1, 100, 10, D("2013-01-07"))],
                                "Store int, Open int, Promo int, DayOfWeek int, Sales long, Customers long, Date date")
    aggs = FE.fit_store_aggregates(fit.withColumn("Month", F.month("Date")))
    rows = spark.createDataFrame([(2, 1, 3, 5)], "Store int, Promo int, DayOfWeek int, Month int")
    r = aggs.transform(rows).first()
    assert r.StoreMeanSales == 100.0 and r.StoreSalesPerCustomer == 10.0 and r.StoreDowMeanSales == 100.0
    assert r.DowSalesIndex == 1.0
