"""Model registry (S13), run tracking (S14) and model comparison (M15).

Models are saved with Spark ML persistence under a shared folder; the
registry and the run log are append-only Parquet tables next to them, so
"latest model" and "best model" are ordinary aggregates (``max_by`` /
``min_by``) over a small table, ordered by a real timestamp column.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

REGISTRY_SCHEMA = ("model_name string, ts timestamp, path string, "
                   "metrics map<string,double>, params map<string,string>")
RUNS_SCHEMA = "run_id string, model_name string, kind string, key string, value string, step int, ts timestamp"


def timestamp_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def registry_path(self) -> str:
        return f"{self.root}/_registry"

    @property
    def runs_path(self) -> str:
        return f"{self.root}/_runs"

    def save(self, model: PipelineModel, model_name: str, metrics: dict | None = None,
             params: dict | None = None, tables: dict[str, DataFrame] | None = None) -> str:
        ts = timestamp_now()
        path = f"{self.root}/{model_name}_{ts.strftime('%Y%m%d-%H%M%S-%f')}"
        model.write().overwrite().save(f"{path}/model")
        for name, t in (tables or {}).items():        # fitted state (store aggregates, calendar)
            t.write.mode("overwrite").parquet(f"{path}/{name}")
        row = [(model_name, ts, path, {k: float(v) for k, v in (metrics or {}).items()},
                {k: str(v) for k, v in (params or {}).items()})]
        self.spark.createDataFrame(row, REGISTRY_SCHEMA).write.mode("append").parquet(self.registry_path)
        return path

    def _table(self, path: str, schema: str) -> DataFrame:
        """The append-only table at ``path``; empty before the first append."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def list_models(self, model_name: str | None = None) -> DataFrame:
        reg = self._table(self.registry_path, REGISTRY_SCHEMA)
        if model_name:
            reg = reg.filter(F.col("model_name") == model_name)
        return reg.orderBy(F.desc("ts"))

    def latest_path(self, model_name: str | None = None) -> str:
        r = self.list_models(model_name).agg(F.max_by("path", "ts").alias("p")).first()
        if r is None or r.p is None:
            raise FileNotFoundError(f"no saved model{' named ' + model_name if model_name else ''}")
        return r.p

    def choose_path(self, model_name: str | None = None) -> str:
        """The latest model of that name, else the latest of any name."""
        try:
            return self.latest_path(model_name)
        except FileNotFoundError:
            return self.latest_path()

    def load(self, path: str | None = None, model_name: str | None = None) -> tuple[PipelineModel, str]:
        path = path or self.latest_path(model_name)
        return PipelineModel.load(f"{path}/model"), path

    def load_table(self, path: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{path}/{name}")

    def log_run(self, model_name: str, params: dict | None = None, metrics: dict | None = None,
                step_metrics: list[tuple[str, int, float]] | None = None) -> str:       # S14
        run_id = uuid.uuid4().hex
        ts = timestamp_now()
        rows = [(run_id, model_name, "param", k, str(v), 0, ts) for k, v in (params or {}).items()]
        rows += [(run_id, model_name, "metric", k, repr(float(v)), 0, ts) for k, v in (metrics or {}).items()]
        rows += [(run_id, model_name, "metric", k, repr(float(v)), s, ts) for k, s, v in (step_metrics or [])]
        self.spark.createDataFrame(rows, RUNS_SCHEMA).write.mode("append").parquet(self.runs_path)
        return run_id

    def log_steps(self, run_id: str, model_name: str, steps: DataFrame) -> None:       # S14
        """Metrics of a run's steps from a table: ``step`` and one column per metric."""
        metrics = [c for c in steps.columns if c != "step"]
        values = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in metrics])
        rows = steps.select(F.lit(run_id).alias("run_id"), F.lit(model_name).alias("model_name"), F.lit("metric").alias("kind"), F.inline(values),
                            F.col("step").cast("int").alias("step"), F.lit(timestamp_now()).alias("ts"))
        rows.write.mode("append").parquet(self.runs_path)

    def runs(self) -> DataFrame:
        return self._table(self.runs_path, RUNS_SCHEMA)


def compare_models(runs: DataFrame, metric: str = "valid_rmspe") -> DataFrame:        # M15
    """One row per run with its final metrics; ``is_best`` marks the run with
    the smallest ``metric`` (min_by over the run table)."""
    m = (runs.filter((F.col("kind") == "metric") & (F.col("step") == 0))
         .groupBy("run_id", "model_name")
         .agg(F.map_from_entries(F.collect_list(F.struct("key", F.col("value").cast("double")))).alias("metrics")))
    m = m.withColumn("score", F.col("metrics")[metric])
    best = m.agg(F.min_by("run_id", "score").alias("_best"))
    from shopcast.functions.stats import with_scalars
    return with_scalars(m, best).withColumn("is_best", (F.col("run_id") == F.col("_best")).cast("int")).drop("_best")
