"""Query catalogue: key -> callable(spark, sf_dir) -> DataFrame, and the
matching SQL twins for the correctness gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopcast.plans.context import build_context, compared_doubles
from shopcast.plans.questions import QUESTIONS


def _ctx_query(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return compared_doubles(fn(build_context(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {}
    from shopcast.plans import operator_queries
    for k, fn in operator_queries.OPERATOR_QUERIES.items():
        out[k] = _ctx_query(fn)
    for k, fn in QUESTIONS.items():
        out[k] = _ctx_query(fn)
    from shopcast.plans.ml_queries import ML_QUERIES
    for k, fn in ML_QUERIES.items():
        out[k] = _ctx_query(fn)
    return out


def sql_twins() -> dict[str, str]:
    from shopcast.plans.oracle_operators import operator_sql, series_sql
    from shopcast.plans.oracle_questions import question_sql
    out = {}
    out.update(operator_sql())
    out.update(series_sql())
    out.update(question_sql())
    return out
