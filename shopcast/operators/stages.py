"""Cleaning, features, model and forecast rules as ``pyspark.ml`` stages, for
one ``Pipeline`` from raw rows to forecasts (C01-C07, C09, C10, M05).

An estimator's fitted state is a set of tables; a model writes them as Parquet
beside its parameters, so a saved pipeline holds everything that was fitted and
loads in another session. Stages that concern training rows (trading days,
outlier fences) act on rows with ``Sales`` only; raw future rows pass.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcast.functions.calendar import DEFAULT_EPOCH
from shopcast.functions.stats import column_medians
from shopcast.operators import clean as C
from shopcast.operators import features as FE
from shopcast.operators import forecast as FC
from shopcast.operators import ml
from shopcast.operators.trees import tree_interval


class _TableWriter(MLWriter):
    def __init__(self, instance: TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, SparkSession.active())
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/{name}")


class _TableReader(MLReader):
    def __init__(self, cls: type[TableModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls({name: spark.read.parquet(f"{path}/{name}") for name in self.cls.TABLES})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TableModel(Model, MLReadable, MLWritable):
    """A model whose state is tables, by the names in ``TABLES``."""

    TABLES: tuple[str, ...] = ()

    def __init__(self, tables: dict[str, DataFrame]):
        super().__init__()
        self.tables = tables

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class AttributeJoinModel(TableModel):
    """Left join of the key's attributes that a row does not carry yet."""

    TABLES = ("attributes",)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = self.tables["attributes"]
        new = [c for c in table.columns if c not in dataset.columns]
        return dataset.join(table.select("Store", *new), "Store", "left") if new else dataset


class AttributeJoin(Estimator):
    """Store attributes, kept with the pipeline."""

    def __init__(self, attributes: DataFrame):
        super().__init__()
        self.attributes = attributes

    def _fit(self, dataset: DataFrame) -> AttributeJoinModel:
        return AttributeJoinModel({"attributes": self.attributes})


class MissingValuesModel(TableModel):
    """C01 with the medians seen at fit."""

    TABLES = ("medians",)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        medians = {r["column"]: r["value"] for r in self.tables["medians"].collect()}     # one row per column
        return C.clean_missing(dataset, medians=medians)


class MissingValues(Estimator):

    def _fit(self, dataset: DataFrame) -> MissingValuesModel:
        spark, gaps = dataset.sparkSession, C.gap_columns(dataset)
        filled = C.clean_missing(dataset, medians={}) if gaps else dataset
        rows = [(c, v) for c, v in column_medians(filled, gaps).items() if v is not None]
        return MissingValuesModel({"medians": spark.createDataFrame(rows, "column string, value double")})


class HolidayFeaturesModel(TableModel):
    """C05 with the calendar seen at fit."""

    TABLES = ("calendar",)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return FE.holiday_features(dataset, self.tables["calendar"])


class HolidayFeatures(Estimator):
    """Learns the holidays of its rows and of further frames (U01)."""

    def __init__(self, *further: DataFrame):
        super().__init__()
        self.further = further

    def _fit(self, dataset: DataFrame) -> HolidayFeaturesModel:
        return HolidayFeaturesModel({"calendar": FE.holiday_calendar(dataset, *self.further)})


class OutlierFencesModel(TableModel):
    """P03 and C02 on rows with sales, with the fences seen at fit."""

    TABLES = ("fences",)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if "Sales" not in dataset.columns:
            return dataset
        return C.handle_outliers(C.trading_days(dataset), fences=self.tables["fences"])


class OutlierFences(Estimator):

    def _fit(self, dataset: DataFrame) -> OutlierFencesModel:
        return OutlierFencesModel({"fences": C.outlier_fences(C.trading_days(dataset))})


class DateFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """C04."""

    epoch = Param(Params._dummy(), "epoch", "first day of the time index", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, epoch: str = DEFAULT_EPOCH):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return FE.date_features(dataset, self.getOrDefault(self.epoch) if self.isDefined(self.epoch) else DEFAULT_EPOCH)


class CompetitionPromoFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """C06."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return FE.competition_promo_features(dataset)


class StoreHistoryModel(TableModel):
    """C07 with the aggregates and fallbacks seen at fit."""

    TABLES = ("stores", "fallbacks")

    @classmethod
    def of(cls, aggs: FE.StoreAggregates) -> StoreHistoryModel:
        rows = [(k, None if v is None else float(v)) for k, v in aggs.fallbacks.items()]
        return cls({"stores": aggs.stores, "fallbacks": aggs.stores.sparkSession.createDataFrame(rows, "column string, value double")})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fallbacks = {r["column"]: r["value"] for r in self.tables["fallbacks"].collect()}     # one row per column
        return FE.StoreAggregates(self.tables["stores"], fallbacks).transform(dataset)


class StoreHistory(Estimator):

    def _fit(self, dataset: DataFrame) -> StoreHistoryModel:
        return StoreHistoryModel.of(FE.fit_store_aggregates(dataset))


class _NestedWriter(MLWriter):
    def __init__(self, instance: SalesRegressionModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, SparkSession.active())
        self.instance.model.write().save(f"{path}/model")


class _NestedReader(MLReader):
    def load(self, path: str) -> SalesRegressionModel:
        model = SalesRegressionModel(PipelineModel.load(f"{path}/model"))
        model._resetUid(DefaultParamsReader.loadMetadata(path, SparkSession.active())["uid"])
        return model


class SalesRegressionModel(Model, MLReadable, MLWritable):
    """PredictedSales of engineered rows; a forest adds its trees' spread."""

    def __init__(self, model: PipelineModel):
        super().__init__()
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = isinstance(self.model.stages[-1], RandomForestRegressionModel)
        return tree_interval(self.model, dataset) if forest else ml.predict(self.model, dataset)

    def write(self) -> MLWriter:
        return _NestedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _NestedReader()


class SalesRegression(Estimator):
    """M01-M09 on engineered rows: columns by type, log target, any regressor."""

    def __init__(self, estimator: str | Estimator = "rf", params: dict | None = None):
        super().__init__()
        self.estimator, self.params_ = estimator, params

    def _fit(self, dataset: DataFrame) -> SalesRegressionModel:
        return SalesRegressionModel(ml.fit_model(dataset, self.estimator, self.params_)[0])


class ForecastRules(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """C09 and C10."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return FC.closed_rule(FC.customers_estimate(dataset))


def feature_stages(store: DataFrame, epoch: str, *further: DataFrame) -> list:
    """The stages from raw rows to engineered ones. ``further``: frames (Date,
    StateHoliday) whose holidays count too."""
    return [AttributeJoin(store), MissingValues(), HolidayFeatures(*further), OutlierFences(), DateFeatures(epoch=epoch),
            CompetitionPromoFeatures(), StoreHistory()]
