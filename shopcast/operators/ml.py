"""Model operators M01-M15 on pyspark.ml.

The engineered frame (C04-C07 output) feeds one ``Pipeline``:
median imputer (M01) -> most-frequent imputer (M03) -> StringIndexer
(alphabetical, unknown kept) + OneHotEncoder(dropLast) so an unseen
category is all zeros (M04) -> VectorAssembler -> StandardScaler on the
numeric block (M02) -> regressor (M08 random forest / M09 GBT) on
log1p(Sales) (F15). Training, scoring, tree intervals and permutation
importance are distributed Spark jobs; only model metadata (feature names,
importances: one number per feature) is read on the driver.
"""

from __future__ import annotations

import time

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcast.functions.stats import lower_medians, row_index, with_scalars
from shopcast.operators.metrics import evaluate
from shopcast.operators.trees import tree_interval  # noqa: F401
from shopcast.sources.schemas import CATEGORICAL_FEATURES

# Fixed value: columns that never become features (target, secondary
# target, keys, the target-derived outlier flag, the constant Open flag,
# the redundant state name, the log target itself).
EXCLUDED_FROM_FEATURES = {"Sales", "Customers", "Date", "Id", "IsSalesOutlier", "Open", "StateName",
                          "LogSales", "split"}
LABEL = "LogSales"

RF_PARAMS = {"numTrees": 150, "maxDepth": 14, "minInstancesPerNode": 25,
             "featureSubsetStrategy": "sqrt", "seed": 42}
# Memory for node statistics per task and pass. Every concurrent task holds
# this much outside Spark's managed memory, so slots x maxMemoryInMB must fit
# the executor's user memory; at sf0.1 (150 trees, 8 slots) 512 MB fitted in
# 145 s, 256 MB in 151 s, and 1024 MB slowed down under memory pressure.
# Node-id caching avoids re-walking every tree per pass (50 trees: 38 s vs 71 s).
# Boosting grows one shallow tree at a time: walking it costs less than writing
# a node per row and level (15 rounds at sf0.1: 19.6 s without, 27.2 s with; the
# trees are the same).
TREE_ENGINE_PARAMS = {"maxMemoryInMB": 512, "cacheNodeIds": True}
# Trees grow level-wise to depth 6 (up to 64 leaves) instead of leaf-wise to 63 leaves.
GBT_PARAMS = {"maxIter": 600, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8", "seed": 42}


def infer_feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:        # P09
    """(numeric, categorical) model inputs from the schema alone."""
    numeric_types = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType)
    usable = [f for f in df.schema.fields if f.name not in EXCLUDED_FROM_FEATURES
              and not f.name.startswith("_")]
    categorical = [f.name for f in usable if f.name in CATEGORICAL_FEATURES]
    numeric = [f.name for f in usable if f.name not in categorical and isinstance(f.dataType, numeric_types)]
    return numeric, categorical


class _ModeParams(HasInputCols):
    modes = Param(Params._dummy(), "modes", "most frequent value per column",
                  typeConverter=TypeConverters.toListString)


class ModeImputer(Estimator, _ModeParams, DefaultParamsReadable, DefaultParamsWritable):   # M03
    """Fill nulls of string columns with the most frequent value seen at fit
    (ties: smallest value). One pass over the fit data for all columns:
    values are stacked as (column, value) rows, counted, and the mode per
    column is a ``min_by`` over (-count, value)."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ModeImputerModel":
        cols = self.getInputCols()
        long = (dataset.select(F.explode(F.array(*[
                    F.struct(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_v")) for c in cols]))
                    .alias("_p"))
                .select("_p._col", "_p._v").filter(F.col("_v").isNotNull()))
        best = (long.groupBy("_col", "_v").count().groupBy("_col")
                .agg(F.min_by("_v", F.struct((-F.col("count")).alias("k"), F.col("_v").alias("v"))).alias("_m")))
        got = {r["_col"]: r["_m"] for r in best.collect()}      # one row per column
        return ModeImputerModel(inputCols=cols, modes=[got.get(c, "") for c in cols])


class ModeImputerModel(Model, _ModeParams, DefaultParamsReadable, DefaultParamsWritable):

    @keyword_only
    def __init__(self, *, inputCols=None, modes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = dict(zip(self.getInputCols(), self.getOrDefault(self.modes)))
        return dataset.fillna(fills)


class MedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):   # M01
    """Fill nulls and NaNs of numeric columns with the exact (lower) median.
    The model is Spark's own and equals that of its ``Imputer`` with
    ``relativeError=0.0``, whose fit holds all values of a column in one task."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        cols, outs = self.getInputCols(), self.getOrDefault(self.outputCols)
        medians = lower_medians(dataset, cols)
        one = dataset.sparkSession.createDataFrame([tuple(medians[c] for c in cols)], T.StructType([T.StructField(c, T.DoubleType()) for c in cols]))
        return Imputer(strategy="median", inputCols=cols, outputCols=outs, relativeError=0.0).fit(one)


def build_preprocessor(numeric: list[str], categorical: list[str]) -> list:       # M01-M04
    imp = [f"{c}__imp" for c in numeric]
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    stages = [MedianImputer(inputCols=numeric, outputCols=imp)]
    if categorical:
        stages += [ModeImputer(inputCols=categorical),
                   StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True)]
    stages += [VectorAssembler(inputCols=imp, outputCol="num_vec", handleInvalid="keep"),
               StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True),
               VectorAssembler(inputCols=["num_scaled"] + ohe, outputCol="features")]
    return stages


def _forest(params: dict) -> Estimator:
    return RandomForestRegressor(labelCol=LABEL, featuresCol="features", **TREE_ENGINE_PARAMS, **{**RF_PARAMS, **params})


def _boosted(params: dict) -> Estimator:
    return GBTRegressor(labelCol=LABEL, featuresCol="features", checkpointInterval=10,
                        **{**TREE_ENGINE_PARAMS, "cacheNodeIds": False, **GBT_PARAMS, **params})


#: Regressors by name; add a function from parameters to an estimator of
#: ``LABEL`` from ``features`` to make another one known.
REGRESSORS = {"rf": _forest, "gbt": _boosted}


def make_regressor(kind: str | Estimator = "rf", params: dict | None = None) -> Estimator:
    """The regressor of a name, or an estimator of the caller's own (its label,
    features and ``params`` are set here)."""
    if isinstance(kind, Estimator):
        own = {"labelCol": LABEL, "featuresCol": "features", **(params or {})}
        return kind.copy({kind.getParam(k): v for k, v in own.items()})
    if kind not in REGRESSORS:
        raise ValueError(f"unknown model kind {kind!r}")
    return REGRESSORS[kind](params or {})


def build_model_pipeline(numeric: list[str], categorical: list[str], kind: str | Estimator = "rf",
                         params: dict | None = None) -> Pipeline:               # M05
    return Pipeline(stages=build_preprocessor(numeric, categorical) + [make_regressor(kind, params)])


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn(LABEL, F.log1p(F.col("Sales").cast("double")))


#: Bytes of feature vectors per partition of the tree learner.
TRAINING_PARTITION_BYTES = 128 << 20


def training_partitions(spark, rows: int, features: int) -> int:
    """Partitions by the size of the vectors, so that a partition fits a task
    at any scale, and at least one per task slot. Every pass of the learner
    ships one statistics block per partition and node group, so small data
    gets no more than the slots (sf0.1, 8 slots, 50 trees: 8 partitions 38 s,
    16 47 s, 32 84 s)."""
    size = rows * (features + 4) * 8
    return max(1, spark.sparkContext.defaultParallelism, -(-size // TRAINING_PARTITION_BYTES))


def fit_model(train: DataFrame, kind: str | Estimator = "rf", params: dict | None = None):   # M06
    """Fit the full pipeline; returns (PipelineModel, fit_seconds, numeric, categorical).

    The preprocessing stages are fitted first; their output is reduced to
    (features, label), spread over partitions by size and persisted, so the
    learner's metadata, split-finding and binning passes read the assembled
    vectors instead of replaying the feature chain. They are kept on disk: a
    block of vectors being cached in memory, and the storage that sorts may not
    evict, took an executor of 3 GB down at 6 million rows. The fitted stages
    are returned as one PipelineModel.
    """
    from pyspark import StorageLevel
    numeric, categorical = infer_feature_columns(train)
    t = time.time()
    labeled = with_label(train)
    pre = Pipeline(stages=build_preprocessor(numeric, categorical)).fit(labeled)
    x = pre.transform(labeled).select("features", LABEL)
    parts = training_partitions(train.sparkSession, labeled.count(), _vector_size(x, "features"))
    x = x.repartition(parts).persist(StorageLevel.DISK_ONLY)
    try:
        reg = make_regressor(kind, params).fit(x)
    finally:
        x.unpersist()
    model = PipelineModel(stages=pre.stages + [reg])
    return model, time.time() - t, numeric, categorical


def _vector_size(df: DataFrame, col: str) -> int:
    """Length of a vector column, from its metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    return int(meta.get("num_attrs") or sum(len(g) for g in meta.get("attrs", {}).values()))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:                   # M10
    """Log-scale prediction plus PredictedSales = expm1(prediction)."""
    return model.transform(df).withColumn("PredictedSales", F.expm1(F.col("prediction")))


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:             # M07
    """Encoded feature names from the assembled vector's ML attributes."""
    out = model.transform(df.limit(0) if "Sales" not in df.columns else with_label(df).limit(0))
    meta = out.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    attrs = sorted([a for group in meta.values() for a in group], key=lambda a: a["idx"])
    return [a["name"] for a in attrs]


def builtin_importance(model: PipelineModel, df: DataFrame) -> DataFrame:        # M11
    """(feature, importance) from the tree ensemble, descending."""
    names = feature_names(model, df)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = df.sparkSession
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def permutation_importance(model: PipelineModel, df: DataFrame, columns: list[str] | None = None,
                           n_repeats: int = 5, seed: int = 42, max_samples: int | None = None,
                           key: tuple[str, ...] = ("Store", "Date")) -> DataFrame:   # M12
    """Increase of RMSE (log scale, against log1p(Sales)) when one model
    input column is permuted, mean and std over ``n_repeats``.

    All rows are scored; ``max_samples`` asks for a seeded sample of so many
    instead. A permutation is a pair of seeded orders: row i of the first takes
    its value from row i of the second. Rows are numbered across partitions
    (``row_index``), so no task holds all of them.
    """
    numeric, categorical = infer_feature_columns(df)
    columns = columns or numeric + categorical

    def replaced(j: DataFrame) -> DataFrame:
        j = j.withColumn("_col", F.explode(F.array(*[F.lit(c) for c in columns])))
        return j.withColumns({c: F.when(F.col("_col") == c, F.col(f"_from.{c}")).otherwise(F.col(c)) for c in columns})

    return importances(model, df, columns, replaced, n_repeats, seed, max_samples, key)


def importances(model: PipelineModel, df: DataFrame, columns: list[str], replaced, n_repeats: int, seed: int,
                max_samples: int | None, key: tuple[str, ...]) -> DataFrame:
    """(feature, importance_mean, importance_std). ``replaced`` gets every row
    beside the row of the permutation (``_from``) and gives the rows to score,
    one per row and column (``_col``)."""
    kcols = [F.col(k) for k in key]
    base = with_label(df).withColumn("_h", F.xxhash64(*kcols, F.lit(seed)))
    if max_samples is not None:
        base = base.orderBy("_h", *key).limit(max_samples)
    base = row_index(base, ["_h", *key], "_rid").drop("_h")
    error = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(LABEL), 2)))
    scores = []
    for rep in range(n_repeats):
        order = base.select(*key, F.struct(*columns).alias("_from"), F.xxhash64(*kcols, F.lit(seed + 1 + rep)).alias("_h"))
        j = base.join(row_index(order, ["_h", *key], "_rid").select("_rid", "_from"), "_rid")
        scores.append(model.transform(replaced(j)).groupBy("_col").agg(error.alias("rmse")))
    per = scores[0]
    for s in scores[1:]:
        per = per.unionByName(s)
    d = with_scalars(per, model.transform(base).agg(error.alias("base_rmse"))).withColumn("drop", F.col("rmse") - F.col("base_rmse"))
    return (d.groupBy(F.col("_col").alias("feature"))
            .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
            .orderBy(F.desc("importance_mean")))


def train_and_evaluate(train: DataFrame, valid: DataFrame, kind: str | Estimator = "rf", params: dict | None = None):
    """Fit on ``train``, score ``valid``; returns (model, predictions, metrics_df, fit_seconds)."""
    model, secs, _, _ = fit_model(train, kind, params)
    pred = predict(model, with_label(valid))
    metrics = evaluate(pred, "Sales", "PredictedSales", prefix="valid_")
    return model, pred, metrics, secs
