"""Pipeline stages with table state, raw importances, staged scores, leaf
tables and leave-one-out aggregates (sf0.001 and micro-frames)."""

import datetime as dt
import os
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopcast.operators import features as FE
from shopcast.operators import ml, stages, trees
from shopcast.operators import raw_importance as RI
from shopcast.operators.bundle import ForecastBundle
from shopcast.operators.registry import ModelRegistry
from shopcast.plans import ml_queries as MQ
from shopcast.plans.context import build_context
from shopcast.session import checkpoint_dir
from shopcast.sources import readers, schemas, sinks


@pytest.fixture(scope="module")
def small(spark):
    ctx = build_context(spark, SF_SMALL)
    train, valid, aggs = MQ.split_frames(ctx)
    return ctx, train, valid, aggs


def new_path(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


def test_saved_pipeline_equals_bundle(spark, small):
    """Fitted pieces as pipeline stages, saved and loaded in a new session,
    forecast raw future rows as the bundle does."""
    ctx, train, _, aggs = small
    for kind, params in (("rf", {"numTrees": 5, "maxDepth": 3, "minInstancesPerNode": 5}), (LinearRegression(regParam=0.1), None)):
        model, _, _, _ = ml.fit_model(train, kind, params)
        made = PipelineModel(stages=[
            stages.AttributeJoinModel({"attributes": ctx.inputs.store}), stages.MissingValues().fit(ctx.inputs.daily),
            stages.HolidayFeaturesModel({"calendar": ctx.calendar}), stages.OutlierFences().fit(ctx.inputs.daily),
            stages.DateFeatures(epoch=ctx.epoch), stages.CompetitionPromoFeatures(), stages.StoreHistoryModel.of(aggs),
            stages.SalesRegressionModel(model), stages.ForecastRules()])
        path = new_path(spark, "stages")
        made.write().save(path)
        loaded = PipelineModel.load(path)
        future = spark.newSession().createDataFrame(ctx.inputs.future.collect(), ctx.inputs.future.schema)
        bundle = ForecastBundle(model, aggs, ctx.calendar, ctx.inputs.store, ctx.epoch)
        want = bundle.predict_rows(ctx.inputs.future)
        got = loaded.transform(future).select(*want.columns)
        a, b = ({r.Id: tuple(r) for r in d.collect()} for d in (want, got))
        assert a.keys() == b.keys() and len(a) == ctx.inputs.future.count()
        for k in a:
            assert a[k][:3] == b[k][:3] and a[k][4:5] == pytest.approx(b[k][4:5], rel=1e-9) and a[k][-1] == b[k][-1]


def test_pipeline_fits_raw_rows_to_forecasts(spark, small):
    ctx, _, _, _ = small
    pipe = Pipeline(stages=[*stages.feature_stages(ctx.inputs.store, ctx.epoch, ctx.test.select("Date", "StateHoliday")),
                            stages.SalesRegression(LinearRegression(regParam=0.1)), stages.ForecastRules()])
    fitted = pipe.fit(ctx.inputs.daily)
    assert {r.Date for r in fitted.stages[2].tables["calendar"].collect()} == {r.Date for r in ctx.calendar.collect()}
    # The engineered training rows are those of the standard frame.
    cols = ["Store", "Date", "IsSalesOutlier", "DaysToNextHoliday", "TimeIndex", "Promo2ActiveWeeks", "StoreMedianSales", "DowSalesIndex"]
    rows = PipelineModel(stages=fitted.stages[:-2]).transform(ctx.inputs.daily)
    a, b = (sorted(map(tuple, d.select(*cols).collect())) for d in (rows, ctx.clean))
    assert a == b
    out = fitted.transform(ctx.inputs.future).select("Open", "PredictedSales", "PredictedCustomers").collect()
    assert len(out) == ctx.inputs.future.count() and all(r.PredictedSales is not None for r in out)
    assert all(r.PredictedSales == 0 and r.PredictedCustomers == 0 for r in out if r.Open == 0)


def test_fitted_medians_fill_other_frames(spark):
    day = dt.date(2001, 1, 1)
    fit = spark.createDataFrame([(1, day, 4.0, 1), (2, day, 10.0, 1), (3, day, 6.0, 1)], "Store int, Date date, TrendDE double, Open int")
    model = stages.MissingValues().fit(fit)
    path = new_path(spark, "medians")
    model.write().save(path)
    empty = spark.createDataFrame([(1, day, None, None), (2, day, 3.0, 0)], "Store int, Date date, TrendDE double, Open int")
    got = {r.Store: (r.TrendDE, r.Open) for r in stages.MissingValuesModel.load(path).transform(empty).collect()}
    assert got == {1: (6.0, 1), 2: (3.0, 0)}


def test_staged_scores_end_at_the_models_own(spark, small):
    _, train, valid, _ = small
    model, pred, metrics, _ = ml.train_and_evaluate(train, valid, "gbt", {"maxIter": 12, "maxDepth": 3})
    steps = {r.step: r for r in trees.staged_metrics(model, valid).collect()}
    assert sorted(steps) == list(range(1, 13))
    last = metrics.first()
    assert steps[12].valid_rmspe == pytest.approx(last.valid_rmspe, rel=1e-9) and steps[12].valid_mae == pytest.approx(last.valid_mae, rel=1e-9)
    boosted = model.stages[-1]
    x = PipelineModel(stages=model.stages[:-1]).transform(valid).select("features", "Sales").collect()
    for k in (1, 5):
        p = np.expm1([sum(w * t.predict(r.features) for t, w in zip(boosted.trees[:k], boosted.treeWeights[:k])) for r in x])
        y = np.array([r.Sales for r in x], float)
        assert steps[k].valid_rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)), rel=1e-9)
    reg = ModelRegistry(spark, new_path(spark, "runs"))
    run = reg.log_run("gbt", {}, {"valid_rmspe": last.valid_rmspe})
    reg.log_steps(run, "gbt", trees.staged_metrics(model, valid).select("step", "valid_rmspe"))
    logged = reg.runs().where("step > 0 and key = 'valid_rmspe'").collect()
    assert len(logged) == 12 and {float(r.value) for r in logged if r.step == 12} == {steps[12].valid_rmspe}


def test_tree_operators_run_without_python_workers(spark, small):
    _, train, valid, _ = small
    model, _, _, _ = ml.fit_model(train, "rf", {"numTrees": 3, "maxDepth": 2})
    plan = trees.tree_interval(model, valid)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_dependents_of_raw_columns(small):
    ctx, _, _, aggs = small
    steps = RI.stages(ctx.calendar, aggs, ctx.epoch)
    assert RI.dependents("Promo2SinceWeek", steps)[0] == steps[2].writes and len(RI.dependents("Promo2SinceWeek", steps)[1]) == 1
    assert RI.dependents("StoreType", steps) == (set(), [])
    assert {"TimeIndex", "DaysToNextHoliday", "CompetitionOpenMonths", "StoreDowMeanSales"} <= RI.dependents("Date", steps)[0]


def test_raw_importance_equals_brute_force(spark, small):
    """Every raw column permuted, all features computed anew by the whole
    chain on plain rows, errors compared."""
    ctx, train, valid, aggs = small
    model, _, _, _ = ml.fit_model(train, "rf", {"numTrees": 5, "maxDepth": 5, "minInstancesPerNode": 5})
    micro = spark.createDataFrame(valid.orderBy(F.xxhash64("Store", "Date")).limit(40).collect(), valid.schema)
    columns, seed, repeats = ["Date", "Promo2SinceWeek", "Store", "Promo", "StateHoliday", "StoreType", "CompetitionDistance"], 7, 2
    got = {r.feature: r for r in RI.raw_permutation_importance(model, micro, ctx.calendar, aggs, ctx.epoch, columns, repeats, seed).collect()}
    assert set(got) == set(columns) and len(RI.RAW_COLUMNS) == 14

    def order(s):
        rows = micro.select("Store", "Date", F.xxhash64("Store", "Date", F.lit(s)).alias("h")).collect()
        return [(r.Store, r.Date) for r in sorted(rows, key=lambda r: (r.h, r.Store, r.Date))]

    def error(df):
        r = model.transform(ml.with_label(df)).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(ml.LABEL), 2)))).first()
        return r[0]

    raw = [c for c in micro.columns if c not in set().union(*(s.writes for s in RI.stages(ctx.calendar, aggs, ctx.epoch)))]
    by_key = {(r.Store, r.Date): r.asDict() for r in micro.collect()}
    base = error(micro)
    for c in columns:
        drops = []
        for rep in range(repeats):
            rows = []
            for a, b in zip(order(seed), order(seed + 1 + rep)):
                row = {k: by_key[a][k] for k in raw}
                row[c] = by_key[b][c]
                rows.append(row)
            schema = micro.select(*raw).schema
            changed = spark.createDataFrame([tuple(r[k] for k in raw) for r in rows], schema)
            full, _ = FE.engineer_features(changed, ctx.calendar, aggs, ctx.epoch)
            drops.append(error(full) - base)
        assert got[c].importance_mean == pytest.approx(np.mean(drops), abs=1e-9), c
        assert got[c].importance_std == pytest.approx(np.std(drops), abs=1e-9), c


def test_leave_one_out_equals_leaving_out(spark):
    r = np.random.default_rng(3)
    rows = [(s, dt.date(2001, 1, 1) + dt.timedelta(days=int(d)), 1, int(r.integers(1, 6)) * 10, int(r.integers(0, 4)), int(r.integers(2)))
            for s, n in ((1, 40), (2, 2), (3, 1), (4, 7)) for d in r.permutation(80)[:n]]
    rows += [(1, dt.date(2002, 1, 1), 0, 0, 0, 1), (5, dt.date(2002, 1, 1), 1, 0, 0, 0)]
    df = spark.createDataFrame(rows, "Store int, Date date, Open int, Sales long, Customers long, Promo int")
    aggs = FE.fit_store_aggregates(df)
    got = {(x.Store, x.Date): x for x in FE.leave_one_out(df, aggs).collect()}
    assert len(got) == len(rows)
    plain = pd.DataFrame(rows, columns=["Store", "Date", "Open", "Sales", "Customers", "Promo"])
    fitted = {(x.Store, x.Date): x for x in aggs.transform(df.withColumn("Month", F.month("Date")).withColumn("DayOfWeek", F.weekday("Date") + 1)).collect()}
    for i, row in plain.iterrows():
        x = got[(row.Store, row.Date)]
        if not (row.Open == 1 and row.Sales > 0):
            assert all(x[c] == fitted[(row.Store, row.Date)][c] for c in FE.LEAVE_ONE_OUT_COLUMNS)
            continue
        o = plain[(plain.Store == row.Store) & (plain.index != i) & (plain.Open == 1) & (plain.Sales > 0)]
        fb = aggs.fallbacks
        want = {c: fb[c] for c in FE.STORE_STAT_COLUMNS + FE.STORE_LOOKUP_COLUMNS}
        if len(o):
            want |= {"StoreMeanSales": o.Sales.mean(), "StoreMedianSales": o.Sales.median(), "StoreMaxSales": o.Sales.max(),
                     "StoreStdSales": 0.0 if len(o) == 1 else o.Sales.std(), "StoreOpenDays": len(o),
                     "StoreMeanCustomers": o.Customers.mean(), "StoreSalesPerCustomer": o.Sales.sum() / max(o.Customers.sum(), 1)}
        for c, same in (("StoreDowMeanSales", [d.weekday() == row.Date.weekday() for d in o.Date]), ("StorePromoMeanSales", o.Promo == row.Promo),
                        ("StoreMonthMeanSales", [d.month == row.Date.month for d in o.Date])):
            some = o[np.array(same, bool)] if len(o) else o
            if len(some):
                want[c] = some.Sales.mean()
        for c, v in want.items():
            assert x[c] == pytest.approx(v, abs=1e-9), (row.Store, c)
        assert x.DowSalesIndex == pytest.approx(want["StoreDowMeanSales"] / want["StoreMeanSales"])


def test_malformed_lines_are_rejects(spark, tmp_path):
    head = ",".join(f.name for f in schemas.DAILY)
    (tmp_path / "a.csv").write_text(f'{head}\n1,2,2001-01-02,10,3,1,0,"0",1\n1,2,never,10,3,1,0,0,1\n\n2,,2001-01-03,,,1,0,"a,b",\n')
    (tmp_path / "b.csv").write_text(f"{head}\n3,2,2001-01-02,ten,3,1,0,0,1\n3,2,2001-01-02\n4,2,2001-01-02,1,3,1,0,0,1,9\n")
    rows, rejects = readers.scan_csv(spark, str(tmp_path), schemas.DAILY)
    got = sorted((r.Store, str(r.Date), r.Sales, r.StateHoliday, r.SchoolHoliday) for r in rows.collect())
    assert got == [(1, "2001-01-02", 10, "0", 1), (2, "2001-01-03", None, "a,b", None)]
    bad = {(os.path.basename(r.file), r.line[:12], r.reason) for r in rejects.collect()}
    assert bad == {("a.csv", "1,2,never,10", "bad date in Date: never"), ("b.csv", "3,2,2001-01-", "bad bigint in Sales: ten"),
                   ("b.csv", "3,2,2001-01-", "3 cells for 9 columns"), ("b.csv", "4,2,2001-01-", "10 cells for 9 columns")}
    assert readers.load_daily(spark, str(tmp_path)).count() == 2


def test_clustered_table_needs_no_exchange(spark, small):
    from shopcast.operators import clean as C
    ctx, _, _, aggs = small
    facts = sinks.write_clustered(ctx.clean.select("Store", "Date", "Sales", "Open", "Promo", "Month", "DayOfWeek", "TrendDE"),
                                  new_path(spark, "clustered"), buckets=8)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        per = facts.groupBy("Store").agg(F.avg("Sales").alias("mean"))
        frames = {"fill": C.fill_forward_back(facts, ["TrendDE"], medians={}), "fence": C.handle_outliers(facts), "join": facts.join(per, "Store")}
        for name, df in frames.items():
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, (name, plan)
    finally:
        spark.conf.set(key, before)
    a, b = (sorted(map(tuple, C.handle_outliers(d).select("Store", "Date", "Sales", "IsSalesOutlier").collect())) for d in (facts, ctx.clean.drop("IsSalesOutlier")))
    assert a == b
