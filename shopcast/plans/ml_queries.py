"""Model catalogue queries (M05-M16, K07, P09-P10). These have no SQL twin:
the driver checks them on row counts; tests check their invariants."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.operators import features as FE
from shopcast.operators import forecast as FC
from shopcast.operators import metrics as M
from shopcast.operators import ml
from shopcast.operators import profile as PR
from shopcast.operators import sampling as S
from shopcast.operators import series as K
from shopcast.operators import stages as ST
from shopcast.operators.bundle import ForecastBundle
from shopcast.operators.raw_importance import raw_permutation_importance
from shopcast.operators.registry import ModelRegistry, compare_models
from shopcast.operators.trees import staged_metrics
from shopcast.plans.context import PanelContext
from shopcast.session import checkpoint_dir

AGG_COLS = FE.STORE_STAT_COLUMNS + FE.STORE_LOOKUP_COLUMNS + ["DowSalesIndex", "MonthSalesIndex"]
# Locality series are unknown for future days, so models train without them
# (the dataset without external joins); State comes with those joins.
PANEL_PARAMS = {"rf": ml.RF_PARAMS, "gbt": ml.GBT_PARAMS}
EXTERNAL_COLS = ["State", "Mean_TemperatureC", "Precipitationmm", "TrendState", "TrendDE"]


def split_frames(ctx: PanelContext):
    """Chronological split of T with store aggregates re-fitted on the
    training part only (the validation score stays honest)."""
    if "split" in ctx.extra:
        return ctx.extra["split"]
    base = S.chrono_split(ctx.clean.drop(*AGG_COLS, *EXTERNAL_COLS))
    train = base.filter(F.col("split") == "train").drop("split")
    valid = base.filter(F.col("split") == "valid").drop("split")
    aggs = FE.fit_store_aggregates(train)
    out = (aggs.transform(train), aggs.transform(valid), aggs)
    ctx.extra["split"] = out
    return out


def fitted(ctx: PanelContext, kind: str):
    key = f"model_{kind}"
    if key not in ctx.extra:
        train, valid, aggs = split_frames(ctx)
        train = train.cache()
        model, pred, metrics, secs = ml.train_and_evaluate(train, valid, kind, PANEL_PARAMS[kind])
        train.unpersist()
        ctx.extra[key] = (model, pred, metrics, secs)
    return ctx.extra[key]


def rf_forecast(ctx: PanelContext) -> DataFrame:                         # M08/M10
    return fitted(ctx, "rf")[1].select("Store", "Date", "Sales", "PredictedSales")


def gbt_forecast(ctx: PanelContext) -> DataFrame:                        # M09
    return fitted(ctx, "gbt")[1].select("Store", "Date", "Sales", "PredictedSales")


def rf_metrics(ctx: PanelContext) -> DataFrame:                          # A21 on the forest
    return fitted(ctx, "rf")[2]


def _plan(ctx: PanelContext, key: str, build) -> DataFrame:
    """Build a (lazy) query plan once per context. The per-tree plans take
    seconds to construct; queries that extend them reuse the plan object
    (execution is still per query)."""
    if key not in ctx.extra:
        ctx.extra[key] = build()
    return ctx.extra[key]


def tree_interval_q(ctx: PanelContext) -> DataFrame:                     # M13
    def build():
        _, valid, _ = split_frames(ctx)
        model = fitted(ctx, "rf")[0]
        return ml.tree_interval(model, valid).select("Store", "Date", "Sales", "PredictedSales",
                                                     "PredictedSalesLower", "PredictedSalesUpper", "tree_std")
    return _plan(ctx, "plan_tree_interval", build)


def rf_interval_coverage(ctx: PanelContext) -> DataFrame:                # M14 on the forest
    return M.interval_coverage(tree_interval_q(ctx), "Sales", "PredictedSalesLower", "PredictedSalesUpper")


def builtin_importance(ctx: PanelContext) -> DataFrame:                  # M11
    _, valid, _ = split_frames(ctx)
    return ml.builtin_importance(fitted(ctx, "rf")[0], valid)


def permutation_importance(ctx: PanelContext) -> DataFrame:              # M12
    _, valid, _ = split_frames(ctx)
    return ml.permutation_importance(fitted(ctx, "rf")[0], valid)


def feature_columns(ctx: PanelContext) -> DataFrame:                     # P09/M07
    """Model inputs with what the training rows hold: values present, smallest
    and largest (as text)."""
    train, _, _ = split_frames(ctx)
    numeric, categorical = ml.infer_feature_columns(train)
    cols = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    one = train.agg(*[F.count(c).alias(f"n_{c}") for c, _ in cols], *[F.min(c).alias(f"lo_{c}") for c, _ in cols],
                    *[F.max(c).alias(f"hi_{c}") for c, _ in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col(f"n_{c}").alias("present"),
                              F.col(f"lo_{c}").cast("string").alias("least"), F.col(f"hi_{c}").cast("string").alias("largest"))
                     for c, k in cols])
    return one.select(F.inline(rows))


def leakage_audit(ctx: PanelContext) -> DataFrame:                       # P10
    """Violations among the fitted model's inputs, by name and by data."""
    train, _, _ = split_frames(ctx)
    numeric, _ = ml.infer_feature_columns(train)
    return PR.leakage_by_data(train, numeric).unionByName(
        PR.leakage_audit(ml.feature_names(fitted(ctx, "rf")[0], train), ctx.spark))


def _requests_from_future(ctx: PanelContext) -> DataFrame:
    e = ctx.test
    return e.select(F.concat(F.lit("store-"), F.col("Store").cast("string")).alias("request_id"), "Store",
                    F.date_format("Date", "yyyy-MM-dd").alias("Date"),
                    (F.coalesce(F.col("StateHoliday"), F.lit("0")) != "0").cast("int").alias("IsHoliday"),
                    (F.weekday("Date") >= 5).cast("int").alias("IsWeekend"),
                    F.col("Promo").alias("IsPromo"), "SchoolHoliday", F.col("Open").cast("int").alias("Open"))


def bundle(ctx: PanelContext, kind: str) -> ForecastBundle:
    return ForecastBundle(fitted(ctx, kind)[0], split_frames(ctx)[2], ctx.calendar, ctx.inputs.store, ctx.epoch)


def forecast_batch(ctx: PanelContext) -> DataFrame:                      # M16
    return _plan(ctx, "plan_forecast_batch", lambda: bundle(ctx, "rf").forecast(_requests_from_future(ctx))[0])


def forecast_gbt(ctx: PanelContext) -> DataFrame:                        # M16 with another model
    return bundle(ctx, "gbt").forecast(_requests_from_future(ctx))[0]


def forecast_totals(ctx: PanelContext) -> DataFrame:
    return FC.forecast_totals(forecast_batch(ctx))


def forecast_stream(ctx: PanelContext) -> DataFrame:                     # M16s
    from shopcast.streaming.forecast_stream import start_forecast_stream
    b = bundle(ctx, "rf")
    root = os.path.join(checkpoint_dir(ctx.spark), f"stream-{uuid.uuid4().hex[:8]}")
    _requests_from_future(ctx).write.parquet(f"{root}/in")
    q = start_forecast_stream(ctx.spark, f"{root}/in", f"{root}/out", f"{root}/chk", b.store, b.calendar, b.aggs, b.model, b.epoch)
    q.awaitTermination()
    return ctx.spark.read.parquet(f"{root}/out").drop("batch")


def forecast_pieces(ctx: PanelContext) -> DataFrame:                     # M16s, requests in pieces
    """The rows of every request dealt over several files and micro-batches."""
    from shopcast.streaming.request_stream import start_request_stream
    b = bundle(ctx, "rf")
    root = os.path.join(checkpoint_dir(ctx.spark), f"pieces-{uuid.uuid4().hex[:8]}")
    req = _requests_from_future(ctx)
    sizes = req.groupBy("request_id").agg(F.count(F.lit(1)).cast("int").alias("n_rows"))
    req.join(sizes, "request_id").repartition(6, "Date").write.parquet(f"{root}/in")
    q = start_request_stream(ctx.spark, f"{root}/in", f"{root}/out", f"{root}/chk", b.store, b.calendar, b.aggs, b.model, b.epoch,
                             files_per_batch=3)
    q.awaitTermination()
    return ctx.spark.read.parquet(f"{root}/out").drop("batch")


def raw_importance(ctx: PanelContext) -> DataFrame:                      # M12 on raw columns
    _, valid, aggs = split_frames(ctx)
    return raw_permutation_importance(fitted(ctx, "rf")[0], valid, ctx.calendar, aggs, ctx.epoch)


def training_curve(ctx: PanelContext) -> DataFrame:                      # S14 with steps
    """Validation error of the boosted model after each step, as logged."""
    runs = _registry(ctx).runs().where("model_name = 'gbt' and kind = 'metric' and key = 'valid_rmspe' and step > 0")
    return runs.select("step", F.col("value").cast("double").alias("valid_rmspe"))


def pipeline_features(ctx: PanelContext) -> DataFrame:                   # C01-C07 as pipeline stages
    """The feature stages, fitted on raw rows, saved, loaded and applied."""
    fitted_ = _feature_pipeline(ctx, "raw", ST.feature_stages(ctx.inputs.store, ctx.epoch, ctx.test.select("Date", "StateHoliday")))
    return fitted_.transform(ctx.raw).select("Store", "Date", "IsSalesOutlier", "TimeIndex", "DaysToNextHoliday", "DaysAfterLastHoliday",
                                             "CompetitionOpenMonths", "Promo2ActiveWeeks", *AGG_COLS)


def pipeline_forecast(ctx: PanelContext) -> DataFrame:                   # raw rows to forecasts in one pipeline
    """Cleaning, features, a linear model and the forecast rules as one
    pipeline, fitted on raw daily rows, saved, loaded, applied to raw future rows."""
    from pyspark.ml.regression import LinearRegression
    stages = ST.feature_stages(ctx.inputs.store, ctx.epoch, ctx.test.select("Date", "StateHoliday"))
    stages += [ST.SalesRegression(estimator=LinearRegression(regParam=0.01)), ST.ForecastRules()]
    return _feature_pipeline(ctx, "daily", stages).transform(ctx.inputs.future).select("Id", "Store", "Date", "PredictedSales", "PredictedCustomers")


def _feature_pipeline(ctx: PanelContext, name: str, stages: list):
    from pyspark.ml import Pipeline, PipelineModel
    path = os.path.join(checkpoint_dir(ctx.spark), f"pipeline-{uuid.uuid4().hex[:8]}")
    Pipeline(stages=stages).fit(ctx.raw if name == "raw" else ctx.inputs.daily).write().save(path)
    return PipelineModel.load(path)


def _registry(ctx: PanelContext) -> ModelRegistry:
    if "registry" not in ctx.extra:
        reg = ModelRegistry(ctx.spark, os.path.join(checkpoint_dir(ctx.spark), f"models-{uuid.uuid4().hex[:8]}"))
        for kind in ("rf", "gbt"):
            m = {k: v for k, v in fitted(ctx, kind)[2].first().asDict().items() if v is not None and k != "valid_n"}
            bundle(ctx, kind).save(reg, kind, m, PANEL_PARAMS[kind])
            run = reg.log_run(kind, PANEL_PARAMS[kind], {**m, "fit_seconds": fitted(ctx, kind)[3]})
            if kind == "gbt":
                reg.log_steps(run, kind, staged_metrics(fitted(ctx, kind)[0], split_frames(ctx)[1]).drop("valid_n"))
        ctx.extra["registry"] = reg
    return ctx.extra["registry"]


def model_compare(ctx: PanelContext) -> DataFrame:                       # S13/S14/M15
    return compare_models(_registry(ctx).runs()).select("model_name", "score", "is_best")


def forecast_saved(ctx: PanelContext) -> DataFrame:                      # M05/S13: load, then score raw rows
    """Raw ``future`` rows scored by the saved bundle; the model asked for is
    not there, so the latest of any name serves."""
    loaded = ForecastBundle.load(ctx.spark, _registry(ctx).root, name="none")
    return loaded.predict_rows(ctx.inputs.future)


def store_listing(ctx: PanelContext) -> DataFrame:                       # M17
    return bundle(ctx, "rf").known_stores()


def log_metrics(ctx: PanelContext) -> DataFrame:                         # A21 on the log scale
    pred = fitted(ctx, "rf")[1]
    return M.evaluate_log(pred, ml.LABEL, "prediction", prefix="expm1_")


def window_forecast(ctx: PanelContext) -> DataFrame:                     # K07
    """Linear model on the 14-value window vector, evaluated on the sales scale."""
    from pyspark.ml.regression import LinearRegression
    w = K.window_vectors(K.windows(K.store_series(ctx.clean), ["Store"]))
    train = w.filter(F.col("split") == "train")
    lr = LinearRegression(featuresCol="features", labelCol="y", regParam=0.0)
    model = lr.fit(train)
    pred = model.transform(w.filter(F.col("split") == "valid"))
    pred = pred.select(K.inverse_scale(F.col("y"), F.col("lo"), F.col("hi")).alias("actual"),
                       K.inverse_scale(F.col("prediction"), F.col("lo"), F.col("hi")).alias("predicted"))
    return M.evaluate(pred, "actual", "predicted")


ML_QUERIES = {
    "rf_forecast": rf_forecast, "gbt_forecast": gbt_forecast, "rf_metrics": rf_metrics,
    "tree_interval": tree_interval_q, "rf_interval_coverage": rf_interval_coverage,
    "builtin_importance": builtin_importance, "permutation_importance": permutation_importance,
    "feature_columns": feature_columns, "leakage_audit": leakage_audit,
    "forecast_batch": forecast_batch, "forecast_gbt": forecast_gbt, "forecast_saved": forecast_saved,
    "store_listing": store_listing, "log_metrics": log_metrics, "forecast_totals": forecast_totals, "forecast_stream": forecast_stream,
    "forecast_pieces": forecast_pieces, "raw_importance": raw_importance, "training_curve": training_curve,
    "pipeline_features": pipeline_features, "pipeline_forecast": pipeline_forecast,
    "model_compare": model_compare, "window_forecast": window_forecast,
}
