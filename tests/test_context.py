"""Frames are planned on first use and write no wide tables; what a panel row
gets from its date is computed once a day."""

import datetime as dt
import glob
import os
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shopcast import session
from shopcast.functions import stats
from shopcast.operators import clean, series
from shopcast.operators.clean import fill_forward_back
from shopcast.operators.joins import load_dataset
from shopcast.plans import questions as Q
from shopcast.plans.context import build_context, clear_cache, compared_doubles
from shopcast.sources import fixture, readers, schemas


@pytest.fixture
def written(monkeypatch, tmp_path):
    """The names of the tables written during a test."""
    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: str(tmp_path))
    clear_cache()
    yield lambda: {os.path.basename(p).rsplit("-", 1)[0] for p in glob.glob(f"{tmp_path}/*")}
    clear_cache()


def test_frames_are_planned_on_first_use(spark, written):
    ctx = build_context(spark, SF_SMALL)
    assert not written()
    Q.q01_weekday(ctx).collect()
    got = written()
    assert "daily" in got and not got & {"raw", "test", "clean", "filled"}
    # Months need no weather: no gap fill is left in the plan.
    monthly = ctx.clean.groupBy("Month").agg(F.avg("Sales"))
    assert "Window" not in monthly._jdf.queryExecution().optimizedPlan().toString()


def test_easter_is_computed_once_a_day(spark):
    span = ("1999-01-01", "2000-12-31")
    daily = fixture.daily_panel(spark, SF_SMALL, span)
    days = fixture.panel_days(spark, *span)
    assert days.count() == 731 and days.select("Date").distinct().count() == 731
    text = daily._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("BroadcastHint") + text.count("strategy=broadcast") >= 1
    got = {r.Date: r.StateHoliday for r in daily.select("Date", "StateHoliday").distinct().collect()}
    assert got[dt.date(1999, 4, 2)] == "b" and got[dt.date(2000, 4, 24)] == "b" and got[dt.date(2000, 12, 25)] == "c"
    assert got[dt.date(2000, 5, 1)] == "a" and got[dt.date(2000, 4, 23)] == "0" and len(got) == 731


@pytest.fixture
def small_tables(spark, tmp_path):
    """Store 1 trades on the first, third and last day, store 2 inside the
    span, store 3 never; one supplier and one line have no key."""
    ts = [dt.datetime(2001, 1, d) for d in range(1, 7)]
    lines = [(10, 1, 100.0, 0.1, ts[0]), (11, 1, 50.0, 0.0, ts[0]), (10, 1, 7.0, 0.0, ts[2]), (99, 1, 3.0, 0.0, ts[5]),
             (11, 2, 20.0, 0.5, ts[3]), (11, None, 9.0, 0.0, ts[1]), (10, 9, 9.0, 0.0, ts[1]), (10, 2, 9.0, 0.0, None)]
    tables = {"lineitem": (lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_discount double, l_shipdate timestamp"),
              "orders": ([(10, 5), (11, 6)], "o_orderkey long, o_custkey long"),
              "supplier": ([(1, 0), (2, 0), (3, 0), (None, 0)], "s_suppkey long, s_nationkey int"),
              "nation": ([(0, "X")], "n_nationkey int, n_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_panel_holds_every_store_and_day(spark, small_tables):
    days = [dt.date(2001, 1, d) for d in range(1, 7)]
    facts = {(1, days[0]): (140, 2), (1, days[2]): (7, 1), (1, days[5]): (3, 0), (2, days[3]): (10, 1)}
    want = []
    for store in (1, 2, 3, None):
        for no, d in enumerate(days):
            is_open = (store, d) in facts or (store is not None and (store + no) % 97 == 0)
            want.append((store, d, *facts.get((store, d), (0, 0)), int(is_open), d.isoweekday()))
    got = fixture.daily_panel(spark, small_tables).select("Store", "Date", "Sales", "Customers", "Open", "DayOfWeek").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    # A span that is narrower than the facts.
    part = fixture.daily_panel(spark, small_tables, ("2001-01-02", "2001-01-04")).collect()
    assert len(part) == 12 and sorted(r.Sales for r in part)[-2:] == [7, 10]


def test_panel_is_made_without_a_shuffle_of_its_days(spark, small_tables, written):
    span = ("2001-01-01", "2001-01-06")
    rows = fixture.panel_rows(session.materialize(fixture.daily_spans(spark, small_tables, span), "spans"), span)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hashpartitioning" not in plan
    # The computus is applied to calendar days, not to rows of the panel.
    holidays = rows.filter("StateHoliday != '0'").select("Date")
    assert holidays._jdf.queryExecution().optimizedPlan().toString().count("Filter NOT CASE") <= 1
    ctx = build_context(spark, small_tables)
    plan = load_dataset(ctx.inputs, "train", with_external=False)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "dimension" in written()


def test_joins_that_bring_no_column_are_dropped(spark, written):
    ctx = build_context(spark, SF_SMALL)
    plan = ctx.raw.select("Store", "Date", "Sales")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "LeftOuter" not in plan      # the calendar days
    assert "LeftOuter" in ctx.raw.select("TrendState")._jdf.queryExecution().optimizedPlan().toString()
    assert ctx.raw.select("Store").count() == ctx.raw.filter("coalesce(Mean_TemperatureC, TrendDE, 0) is not null").count()


def test_lines_are_dealt_once(spark, small_tables):
    plan = fixture.daily_facts(spark, small_tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(("look", "passes"), [(1, 0), (1 << 40, 1)])
def test_a_few_days_settle_what_is_filled(spark, monkeypatch, look, passes):
    monkeypatch.setattr(clean, "FIRST_LOOK", look)
    rows = [(k, d, 1.0 if k != 2 or d == 5 else None, float(d) if k == 3 else None) for k in (None, 1, 2, 3) for d in range(8)]
    df = spark.createDataFrame(rows, "Store int, Date int, a double, b double")
    assert clean.unfilled(df, ["a"], "Store", "Date", "store") == []
    assert clean.unfilled(df, ["a", "b"], "Store", "Date", "store") == ["b"]
    # In scope frame store 3 lends b to the earlier ones, not to the null one.
    assert clean.unfilled(df.filter("Store is not null"), ["a", "b"], "Store", "Date", "frame") == []
    seen = []
    monkeypatch.setattr(clean, "with_scalars", lambda *a: seen.append(a) or stats.with_scalars(*a))
    clean.unfilled(df, ["a"], "Store", "Date", "frame")
    assert len(seen) == passes


def test_gap_fill_stays_a_plan_and_medians_fill_what_is_left(spark, written):
    s = "Store int, Date int, a double, b double"
    full = spark.createDataFrame([(1, 1, None, 2.0), (1, 2, 5.0, None), (2, 1, 7.0, 1.0), (None, 1, 3.0, 4.0)], s)
    out = fill_forward_back(full, ["a", "b"])
    assert "filled" not in written()
    assert sorted(map(repr, (tuple(r) for r in out.collect()))) == sorted(
            ["(1, 1, 5.0, 2.0)", "(1, 2, 5.0, 2.0)", "(2, 1, 7.0, 1.0)", "(None, 1, 3.0, 4.0)"])
    assert "Window" not in out.select("Date")._jdf.queryExecution().optimizedPlan().toString()
    left = spark.createDataFrame([(1, 1, 4.0, 1.0), (2, 1, None, None), (3, 1, 6.0, None)], s)
    by_store = {r.Store: (r.a, r.b) for r in fill_forward_back(left, ["a", "b"]).collect()}
    assert by_store == {1: (4.0, 1.0), 2: (5.0, 1.0), 3: (6.0, 1.0)}
    # Store 2 borrows 6 from store 3; nobody lends b, so its median fills.
    frame = {r.Store: (r.a, r.b) for r in fill_forward_back(left, ["a", "b"], scope="frame").collect()}
    assert frame == {1: (4.0, 1.0), 2: (6.0, 1.0), 3: (6.0, 1.0)}
    # A value without a date is no first value of its key: it is not lent.
    undated = spark.createDataFrame([(1, 1, None, 1.0), (2, None, 9.0, 1.0), (3, 1, None, 1.0)], s)
    frame = {r.Store: r.a for r in fill_forward_back(undated, ["a"], scope="frame").collect()}
    assert frame == {1: 9.0, 2: 9.0, 3: 9.0}


def test_lines_are_classified_in_one_pass(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Store,State\n1,BE\n"2","N,W"\nx,BE\n3\nStore,State\n4,Store\n"Store",State\n')
    lines = readers.classified_lines(spark, str(tmp_path / "s.csv"), schemas.STORE_STATES)
    got = sorted((r._line, r._why, r.Store, r.State) for r in lines.collect())
    assert [(g[0], g[1] is None) for g in got] == [('"2","N,W"', True), ("1,BE", True), ("3", False), ("4,Store", True), ("x,BE", False)]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_cross_moments_compute_half_of_the_matrix(spark):
    df = spark.createDataFrame([([1.0, 4.0, 2.0, 8.0, 5.0, 7.0],)], "x array<double>")
    d = F.zip_with(F.slice("x", 2, 5), F.slice("x", 1, 5), lambda b, a: b - a)
    m = series._cross_moments(F.col("x"), d, F.lit(1))
    assert "least" in df.select(m.alias("m"))._jdf.queryExecution().analyzed().toString()
    cols = [[1.0] * 4, [4.0, 2.0, 8.0, 5.0], [3.0, -2.0, 6.0, -3.0], [-2.0, 6.0, -3.0, 2.0]]
    assert df.select(m.alias("m")).first().m == [sum(a * b for a, b in zip(x, y)) for x in cols for y in cols]


def test_many_doubles_are_rounded_in_short_methods(spark):
    values = [None, float("nan"), float("inf"), 0.0, 2.5e-4, 0.1234567891, -123.4567895, 999999999.9999999, -1e9, 123456789012.345, 1e15]
    want = [None, "nan", float("inf"), 0.0, 2.5e-4, 0.123457, -123.456789, 1e9, -1e9, 123456789012.35, 1e15]
    few = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    many = few.select("i", *[F.col("x").alias(f"x{k}") for k in range(18)], F.lit("a").alias("s"))
    assert [r.x if r.x == r.x else "nan" for r in compared_doubles(few).orderBy("i").collect()] == want
    out = compared_doubles(many)
    assert out.dtypes == many.dtypes
    for r in out.orderBy("i").collect():
        assert {x if x == x else "nan" for x in r[1:-1]} == {want[r.i]}
    plan = compared_doubles(spark.range(9).select(*[(F.rand(k) * F.col("id")).alias(f"x{k}") for k in range(18)]))
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(debug, "MODULE$").codegenString(plan._jdf.queryExecution().executedPlan())
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000
