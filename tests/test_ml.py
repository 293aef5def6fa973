"""Model layer: encoders, tree intervals, forecast rules, registry,
permutation importance and the streaming forecast (sf0.001, small forests)."""

import os
import uuid

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopcast.operators import forecast as FC
from shopcast.operators import ml
from shopcast.operators.joins import join_dimension
from shopcast.operators.registry import ModelRegistry, compare_models
from shopcast.plans import ml_queries as MQ
from shopcast.plans.context import build_context
from shopcast.session import checkpoint_dir

SMALL_RF = {"numTrees": 7, "maxDepth": 4, "minInstancesPerNode": 5}


@pytest.fixture(scope="module")
def small(spark):
    ctx = build_context(spark, SF_SMALL)
    train, valid, aggs = MQ.split_frames(ctx)
    model, secs, _, _ = ml.fit_model(train, "rf", SMALL_RF)
    return ctx, train, valid, aggs, model


def test_one_hot_unknown_is_all_zero(spark):
    fit = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "b"), (4.0, "c")], "x double, cat string")
    pipe = Pipeline(stages=ml.build_preprocessor(["x"], ["cat"])).fit(fit)
    apply = spark.createDataFrame([(1, 1.0, "a"), (2, 1.0, "z"), (3, 1.0, "c")], "i int, x double, cat string")
    got = {r.i: r.cat__ohe.toArray().tolist() for r in pipe.transform(apply).collect()}
    assert got == {1: [1.0, 0.0, 0.0], 2: [0.0, 0.0, 0.0], 3: [0.0, 0.0, 1.0]}


def test_mode_imputer_ties_take_smallest(spark):
    df = spark.createDataFrame([("b", "x"), ("c", None), ("c", "y"), (None, "y"), ("b", None)],
                               "p string, q string")
    m = ml.ModeImputer(inputCols=["p", "q"]).fit(df)
    assert m.getOrDefault(m.modes) == ["b", "y"]
    filled = sorted((r.p, r.q) for r in m.transform(df).collect())
    assert filled == sorted([("b", "x"), ("c", "y"), ("c", "y"), ("b", "y"), ("b", "y")])


def test_training_partitions_follow_size_and_slots(spark):
    slots = spark.sparkContext.defaultParallelism
    assert ml.training_partitions(spark, 1000, 80) == slots
    assert ml.training_partitions(spark, 10 ** 9, 80) == -(-10 ** 9 * 84 * 8 // ml.TRAINING_PARTITION_BYTES) > slots


def test_own_regressor_and_unknown_name(small):
    from pyspark.ml.regression import LinearRegression
    _, train, valid, _, _ = small
    model, _, _, _ = ml.fit_model(train, LinearRegression(maxIter=5), {"regParam": 0.5})
    assert model.stages[-1].getRegParam() == 0.5 and model.stages[-1].getLabelCol() == ml.LABEL
    assert ml.predict(model, valid).filter(F.col("PredictedSales").isNotNull()).count() == valid.count()
    with pytest.raises(ValueError):
        ml.make_regressor("none")


def test_tree_interval_matches_individual_trees(small):
    ctx, train, valid, aggs, model = small
    forest = model.stages[-1]
    out = ml.tree_interval(model, valid)
    pre = PipelineModel(stages=model.stages[:-1]).transform(valid)
    feats = {(r.Store, r.Date): r.features for r in pre.select("Store", "Date", "features").limit(6).collect()}
    got = {(r.Store, r.Date): r for r in out.collect()}
    forest_pred = {(r.Store, r.Date): r.prediction for r in model.transform(ml.with_label(valid)).collect()}
    trees = forest.trees
    for k, v in feats.items():
        per_tree = np.array([t.predict(v) for t in trees])
        r = got[k]
        assert r.tree_mean == pytest.approx(per_tree.mean(), abs=1e-9)
        assert r.tree_mean == pytest.approx(forest_pred[k], abs=1e-9)
        assert r.tree_lower == pytest.approx(np.percentile(per_tree, 2.5), abs=1e-9)
        assert r.tree_upper == pytest.approx(np.percentile(per_tree, 97.5), abs=1e-9)
        assert r.tree_std == pytest.approx(per_tree.std(), abs=1e-9)
        assert r.PredictedSalesLower <= r.PredictedSales <= r.PredictedSalesUpper
    assert out.count() == valid.count()


def test_tree_interval_requires_forest(small, spark):
    ctx, train, valid, aggs, _ = small
    gbt, _, _, _ = ml.fit_model(train, "gbt", {"maxIter": 2, "maxDepth": 2})
    with pytest.raises(TypeError):
        ml.tree_interval(gbt, valid)


def test_closed_rule_zeroes_sales_bounds_customers(spark):
    df = spark.createDataFrame([(0, 10.0, 5.0, 20.0, 3), (1, 10.0, 5.0, 20.0, 3)],
                               "Open int, PredictedSales double, PredictedSalesLower double, "
                               "PredictedSalesUpper double, PredictedCustomers bigint")
    rows = {r.Open: r for r in FC.closed_rule(df).collect()}
    assert tuple(rows[0])[1:] == (0.0, 0.0, 0.0, 0)
    assert tuple(rows[1])[1:] == (10.0, 5.0, 20.0, 3)


def test_registry_latest_and_best(small, spark):
    model = small[4]
    reg = ModelRegistry(spark, os.path.join(checkpoint_dir(spark), f"reg-{uuid.uuid4().hex[:8]}"))
    with pytest.raises(FileNotFoundError):
        reg.latest_path("rf")
    first = reg.save(model, "rf", {"valid_rmspe": 0.3})
    second = reg.save(model, "rf", {"valid_rmspe": 0.2})
    assert reg.latest_path("rf") == second != first
    loaded, path = reg.load(model_name="rf")
    assert path == second and len(loaded.stages) == len(model.stages)
    reg.log_run("rf", {"numTrees": 7}, {"valid_rmspe": 0.3})
    best = reg.log_run("gbt", {"maxIter": 2}, {"valid_rmspe": 0.1})
    cmp = {r.run_id: r.is_best for r in compare_models(reg.runs()).collect()}
    assert cmp[best] == 1 and sum(cmp.values()) == 1


def test_permutation_importance_constant_columns_are_zero(small):
    ctx, train, valid, aggs, model = small
    imp = ml.permutation_importance(model, valid, n_repeats=2, max_samples=500)
    rows = {r.feature: r for r in imp.collect()}
    numeric, categorical = ml.infer_feature_columns(valid)
    assert set(rows) == set(numeric + categorical)
    sample_n = min(500, valid.count())
    assert sample_n > 0
    const = [c for c in numeric + categorical
             if valid.agg(F.countDistinct(F.coalesce(F.col(c).cast("string"), F.lit("<null>")))).first()[0] == 1]
    assert const, "the validation weeks should hold some constant calendar columns"
    for c in const:
        assert rows[c].importance_mean == 0.0 and rows[c].importance_std == 0.0


def test_permutation_importance_scores_all_rows(small):
    _, _, valid, _, model = small
    one = ml.permutation_importance(model, valid, columns=["Promo", "StoreDowMeanSales"], n_repeats=2)
    again = ml.permutation_importance(model, valid.repartition(7), columns=["Promo", "StoreDowMeanSales"], n_repeats=2)
    a, b = ({r.feature: r.importance_mean for r in d.collect()} for d in (one, again))
    assert a == pytest.approx(b) and len(a) == 2


def requests(spark, rows):
    return spark.createDataFrame(rows, "request_id string, Store int, Date string, IsHoliday int, IsPromo int, Open int")


def test_bad_rows_are_rejected_with_their_reason(small, spark):
    ctx, _, _, aggs, model = small
    rows = [("a", 1, "2001-11-10", 0, 0, 1), ("a", 1, "not-a-date", 0, 0, 1), ("a", 99999, "2001-11-10", 0, 0, 1)]
    rows += [("big", 2, "2001-11-10", 0, 0, 1)] * (FC.MAX_REQUEST_ROWS + 1)
    out, rejected = FC.forecast_batch(requests(spark, rows), ctx.inputs.store, ctx.calendar, aggs, model, ctx.epoch)
    assert [(r.request_id, r.Store) for r in out.collect()] == [("a", 1)]
    reasons = {(r.request_id, r.reason): r["count"] for r in rejected.groupBy("request_id", "reason").count().collect()}
    assert reasons == {("a", "unparsable_date"): 1, ("a", "unknown_store"): 1, ("big", "too_many_rows"): FC.MAX_REQUEST_ROWS + 1}


def test_empty_request_is_a_violation(spark):
    req = requests(spark, [("a", 1, "2001-11-10", 0, 0, 1)])
    ids = spark.createDataFrame([("a",), ("none",)], "request_id string")
    got = {(r.request_id, r.rule): r.violations for r in FC.validate_requests(req, ids=ids).collect()}
    assert got[("none", "empty_request")] == 1 and got[("a", "empty_request")] == 0 and len(got) == 8


def test_requests_do_not_touch_each_other(small, spark):
    from shopcast.operators.features import holiday_features, request_holidays
    cal = spark.createDataFrame([("2001-12-01",)], "Date string").select(F.to_date("Date").alias("Date"))
    rows = [(r, s, f"2001-11-{d:02d}", "a" if (r, d) == ("y", 12) else "0") for r in "xy" for s in (1, 2) for d in range(10, 16)]
    df = spark.createDataFrame(rows, "request_id string, Store int, Date string, StateHoliday string").withColumn("Date", F.to_date("Date"))
    got = {(r.request_id, r.Date.day): (r.DaysToNextHoliday, r.DaysAfterLastHoliday, r.IsDayBeforeHoliday)
           for r in request_holidays(holiday_features(df, cal)).collect()}
    assert got[("x", 10)] == (21, 999, 0) and got[("x", 14)] == (17, 999, 0)
    assert got[("y", 10)] == (2, 999, 0) and got[("y", 11)] == (1, 999, 1) and got[("y", 12)] == (0, 999, 0)
    assert got[("y", 14)] == (17, 2, 0)


def test_customers_ties_go_to_even(spark):
    df = spark.createDataFrame([(5.0, 2.0), (7.0, 2.0), (1.0, 0.0)], "PredictedSales double, StoreSalesPerCustomer double")
    assert [r.PredictedCustomers for r in FC.customers_estimate(df).collect()] == [2, 4, None]


def test_bundle_scores_raw_rows_after_loading(small, spark):
    from shopcast.operators.bundle import ForecastBundle
    ctx, _, _, aggs, model = small
    made = ForecastBundle(model, aggs, ctx.calendar, ctx.inputs.store, ctx.epoch)
    root = os.path.join(checkpoint_dir(spark), f"bundle-{uuid.uuid4().hex[:8]}")
    made.save(ModelRegistry(spark, root), "rf")
    loaded = ForecastBundle.load(spark.newSession(), root, name="other")
    assert loaded.aggs.fallbacks == pytest.approx(aggs.fallbacks) and loaded.epoch == ctx.epoch
    a = sorted(map(tuple, made.predict_rows(ctx.inputs.future).collect()))
    b = sorted(map(tuple, loaded.predict_rows(loaded.store.sparkSession.createDataFrame(
        ctx.inputs.future.collect(), ctx.inputs.future.schema)).collect()))
    assert a == b and len(a) == ctx.inputs.future.count()
    # A store that the bundle does not know gets the fallbacks, not NULLs.
    other = ctx.inputs.future.withColumn("Store", F.lit(4711))
    assert made.predict_rows(other).filter(F.col("PredictedSales").isNull()).count() == 0
    assert loaded.known_stores().count() == ctx.inputs.store.count()


@pytest.mark.parametrize("files", [1, 2])
def test_stream_matches_batch(small, spark, files):
    from shopcast.streaming.forecast_stream import start_forecast_stream
    ctx, train, valid, aggs, model = small
    req = MQ._requests_from_future(ctx).unionByName(requests(spark, [
        ("bad", 99999, "2001-11-10", 1, 0, 1), ("bad", 1, "x", 0, 0, 1)]), allowMissingColumns=True)
    batch, rejected = FC.forecast_batch(req, ctx.inputs.store, ctx.calendar, aggs, model, ctx.epoch)
    root = os.path.join(checkpoint_dir(spark), f"stream-test-{uuid.uuid4().hex[:8]}")
    req.repartition(files, "request_id").write.parquet(f"{root}/in")
    q = start_forecast_stream(spark, f"{root}/in", f"{root}/out", f"{root}/chk", ctx.inputs.store,
                              ctx.calendar, aggs, model, ctx.epoch, files_per_batch=1)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{root}/out")
    assert streamed.select("batch").distinct().count() == files
    cols = batch.columns
    a = sorted(tuple(r) for r in batch.select(*cols).collect())
    b = sorted(tuple(r) for r in streamed.select(*cols).collect())
    assert a == b and len(a) == req.count() - 2
    assert rejected.count() == 2 == spark.read.parquet(f"{root}/out_rejected").count()


def test_join_is_the_same_with_and_without_broadcast(spark):
    ctx = build_context(spark, SF_SMALL)
    daily, store = ctx.inputs.daily, ctx.inputs.store
    agg = [F.count("*"), F.sum("Sales"), F.sum(F.coalesce("CompetitionDistance", F.lit(0.0)))]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, sums = spark.conf.get(key), []
    try:
        for threshold in ("100m", "-1"):
            spark.conf.set(key, threshold)
            sums.append(join_dimension(daily, store, ["Store"]).agg(*agg).first())
    finally:
        spark.conf.set(key, before)
    assert sums[0] == sums[1]


def test_catalogue_fits_all_rounds():
    assert MQ.PANEL_PARAMS["gbt"]["maxIter"] == 600 and MQ.PANEL_PARAMS["gbt"]["stepSize"] == 0.05


def test_boosting_walks_its_shallow_trees(spark):
    """Without cached node ids, and with the same trees as with them."""
    from pyspark.ml.functions import array_to_vector
    x = spark.range(400).select(array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double"))).alias("features"),
                                (F.col("id") % 7 * 2 + F.col("id") % 5).cast("double").alias(ml.LABEL))
    boosted = ml.make_regressor("gbt", {"maxIter": 4, "maxDepth": 3})
    assert not boosted.getCacheNodeIds() and ml.make_regressor("rf").getCacheNodeIds()
    a, b = (m.fit(x).toDebugString.split("\n", 1)[1] for m in (boosted, boosted.copy().setCacheNodeIds(True)))
    assert a == b


def test_median_imputer_equals_the_exact_one_of_spark(spark):
    from pyspark.ml.feature import Imputer
    rng = np.random.default_rng(3)
    rows = [(int(i % 4), None if i % 3 == 0 else float(rng.integers(0, 9)), float("nan") if i % 5 == 0 else float(rng.normal()), float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d double").repartition(5)
    cols, outs = list("abcd"), [f"{c}_imp" for c in "abcd"]
    fit = ml.MedianImputer(inputCols=cols, outputCols=outs).fit
    spark_fit = Imputer(strategy="median", inputCols=cols, outputCols=outs, relativeError=0.0).fit
    for part in (df, df.where("d < 51"), df.where("d = 1")):
        assert fit(part).surrogateDF.first() == spark_fit(part).surrogateDF.first()
    assert sorted(map(repr, fit(df).transform(df).collect())) == sorted(map(repr, spark_fit(df).transform(df).collect()))
    assert "MedianImputer" in str(ml.build_preprocessor(cols, [])[0])
    empty = df.withColumn("b", F.lit(None).cast("double"))
    for f in (fit, spark_fit):
        with pytest.raises(Exception, match="surrogate"):
            f(empty)
