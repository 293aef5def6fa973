"""Error metrics A21 and interval coverage M14: single-pass aggregates,
optionally per group. Rows with y = 0 are masked for rmspe/mape; the value
is NULL when none are left."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metric_columns(y: str, yhat: str, prefix: str = "") -> list:
    yc, pc = F.col(y).cast("double"), F.col(yhat).cast("double")
    err = yc - pc
    nz = yc != 0
    return [
        F.sqrt(F.avg(F.when(nz, F.pow(F.try_divide(err, yc), 2)))).alias(f"{prefix}rmspe"),
        F.sqrt(F.avg(F.pow(err, 2))).alias(f"{prefix}rmse"),
        F.avg(F.abs(err)).alias(f"{prefix}mae"),
        F.avg(F.when(nz, F.try_divide(F.abs(err), F.abs(yc)))).alias(f"{prefix}mape"),
        (F.lit(1.0) - F.try_divide(F.sum(F.pow(err, 2)), F.count(yc) * F.var_pop(yc))).alias(f"{prefix}r2"),
        F.count(F.lit(1)).cast("bigint").alias(f"{prefix}n"),
    ]


def evaluate(df: DataFrame, y: str, yhat: str, prefix: str = "", by: list[str] | None = None) -> DataFrame:
    """rmspe, rmse, mae, mape, r2, n (one row, or one per group)."""
    cols = metric_columns(y, yhat, prefix)
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def evaluate_log(df: DataFrame, y_log: str, yhat_log: str, prefix: str = "") -> DataFrame:
    """Metrics on the sales scale for log1p-scale columns (rmspe_expm1 etc.)."""
    d = df.select(F.expm1(F.col(y_log)).alias("_y"), F.expm1(F.col(yhat_log)).alias("_p"))
    return evaluate(d, "_y", "_p", prefix)


def interval_coverage(df: DataFrame, y: str, lower: str, upper: str) -> DataFrame:   # M14
    return df.agg(F.avg(F.col(y).between(F.col(lower), F.col(upper)).cast("double")).alias("coverage"),
                  F.avg(F.col(upper) - F.col(lower)).alias("mean_width"),
                  F.count(F.lit(1)).cast("bigint").alias("n"))


class RmspeEvaluator(Evaluator):
    """RMSPE on the sales scale for pyspark.ml tuning (smaller is better).

    ``log_scale=True`` when label and prediction are log1p(Sales).
    """

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction", log_scale: bool = True):
        super().__init__()
        self.labelCol, self.predictionCol, self.log_scale = labelCol, predictionCol, log_scale

    def _evaluate(self, dataset: DataFrame) -> float:
        y, p = F.col(self.labelCol), F.col(self.predictionCol)
        if self.log_scale:
            y, p = F.expm1(y), F.expm1(p)
        r = dataset.select(y.alias("y"), p.alias("p")).agg(
            F.sqrt(F.avg(F.when(F.col("y") != 0, F.pow(F.try_divide(F.col("y") - F.col("p"), F.col("y")), 2))))).first()[0]
        return float(r) if r is not None else float("nan")

    def isLargerBetter(self) -> bool:
        return False
