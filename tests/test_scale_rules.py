"""Rules that only show on many values, degenerate input or odd files."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from dateutil.easter import easter
from pyspark.sql import functions as F

from shopcast.functions import stats
from shopcast.operators import profile, sampling, series
from shopcast.operators.clean import next_non_null
from shopcast.operators.metrics import RmspeEvaluator, evaluate_log
from shopcast.plans.context import compared
from shopcast.sources import readers, schemas, sinks
from shopcast.sources.fixture import easter_sunday

N = 60_000


@pytest.fixture(scope="module")
def values(spark):
    """N rows, nearly all values different, in two groups of unequal size."""
    r = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": np.where(np.arange(N) % 3 == 0, "a", "b"), "x": r.permutation(N * 2)[:N] / 7.0,
                        "y": r.normal(size=N).round(4)})
    pdf.loc[pdf.g == "a", "x"] += 500
    return pdf, spark.createDataFrame(pdf).repartition(8)


@pytest.fixture(params=["true", "false"])
def exchange_reuse(spark, request):
    key = "spark.sql.exchange.reuse"
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.unset(key)


def test_ranks_quantiles_and_tests_on_many_values(values, exchange_reuse):
    pdf, df = values
    ranks = df.select("x").distinct().withColumn("_c", F.lit(1))
    got = {r.x: r._rank for r in stats.rank_table(ranks, "x", num_partitions=8).collect()}
    want = pdf.x.drop_duplicates().rank()
    assert all(got[x] == w for x, w in zip(pdf.x.drop_duplicates(), want))
    q = {r.g: r.m for r in stats.exact_quantiles(df, "x", [0.37], ["m"], ["g"]).collect()}
    assert q == {g: pytest.approx(float(np.quantile(v, 0.37)), abs=1e-9) for g, v in pdf.groupby("g").x}
    u = stats.mann_whitney(df, "x", "g", "a", "b").first()
    rank, n1 = pdf.x.rank(), int((pdf.g == "a").sum())
    assert u.u_statistic == rank[pdf.g == "a"].sum() - n1 * (n1 + 1) / 2
    rho = {r.g: r.spearman for r in stats.spearman(df, "x", "y", ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert rho[g] == pytest.approx(part.x.rank().corr(part.y.rank()), abs=1e-9)


def test_next_non_null_on_many_keys(spark, exchange_reuse):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 97 == 5, F.col("id") * 2).alias("v")).repartition(8)
    got = {r.id: r.n for r in next_non_null(df, "id", ["v"], ["n"], num_partitions=8).collect()}
    for i in range(0, 30_000, 311):
        nxt = next((k for k in range(i + 1, 30_000) if k % 97 == 5), None)
        assert got[i] == (None if nxt is None else nxt * 2)


def test_row_index_numbers_all_rows(values):
    _, df = values
    rows = stats.row_index(df, ["x", "y"], "i").select("i", "x").collect()
    assert sorted(r.i for r in rows) == list(range(N))
    assert [r.x for r in sorted(rows, key=lambda r: r.i)] == sorted(r.x for r in rows)


def test_zero_denominators_give_null(spark):
    flat = spark.createDataFrame([(1, 1, 5.0, "a"), (1, 1, 5.0, "b"), (1, 1, 5.0, "a")], "Store int, Open int, Sales double, g string")
    assert profile.outlier_report(flat).first().max_zscore is None
    u = stats.mann_whitney(flat, "Sales", "g", "a", "b").first()
    assert u.u_statistic == 1.0 and u.p_value is None
    assert flat.limit(2).agg(stats.corrected_skewness(F.col("Sales")).alias("s")).first().s is None
    chi2, p = stats.chi2_yates_2x2(*[F.lit(x) for x in (0, 0, 3, 4)])
    assert spark.range(1).select(chi2.alias("c"), p.alias("p")).first() == (None, None)
    assert [tuple(r) for r in stats.histogram(flat, "Sales", 4).collect()] == [(0, 5.0, 5.0, 3)]


def test_degenerate_series_have_null_statistics(spark):
    rows = [("flat", i, 3.0) for i in range(40)] + [("one", 0, 1.0)] + [("walk", i, float(np.sin(i * i))) for i in range(60)]
    s = spark.createDataFrame(rows, "id string, Date int, value double")
    got = {r.id: r for r in series.adf(s, ["id"]).collect()}
    assert got["flat"].statistic is None and got["one"].p_value is None and got["walk"].statistic is not None
    acf = series.acf(s, ["id"], nlags=5)
    by = {(r.id, r.lag): r.acf for r in acf.collect()}
    assert by[("flat", 0)] is None and by[("one", 0)] is None and by[("walk", 0)] == 1.0 and ("one", 1) not in by
    v = np.array([r[2] for r in rows if r[0] == "walk"])
    d = v - v.mean()
    assert by[("walk", 3)] == pytest.approx((d[3:] @ d[:-3]) / (d @ d), abs=1e-12)
    parts = {(r.id, r.lag): r.pacf for r in series.pacf(acf, ["id"]).collect()}
    assert np.isnan(parts[("flat", 1)] if parts[("flat", 1)] is not None else np.nan) and parts[("walk", 0)] == 1.0
    kept = series.difference_if_needed(s, series.adf(s, ["id"]), ["id"]).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in kept}["flat"] == 40


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "states.csv").write_text("State,Store\nBE,1\nNW,2\n")
    rows = readers.read_csv(spark, str(tmp_path / "states.csv"), schemas.STORE_STATES).collect()
    assert {(r.Store, r.State) for r in rows} == {(1, "BE"), (2, "NW")}
    (tmp_path / "bad.csv").write_text("Shop,State\n1,BE\n")
    with pytest.raises(ValueError, match="Store"):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), schemas.STORE_STATES)


def test_csv_round_trip_of_all_inputs(spark, tmp_path):
    from shopcast.operators.joins import load_dataset
    made = readers.RetailInputs.from_fixture(spark, "/root/testdata/sf0.001")
    files = {"train": made.daily.limit(300), "test": made.future.limit(100), "store": made.store, "store_states": made.store_states,
             "state_names": made.state_names, "weather": made.weather, "googletrend": made.trend_raw}
    for name, df in files.items():
        sinks.write_csv(df, str(tmp_path / f"{name}.csv"))
    read = readers.RetailInputs.from_csv(spark, str(tmp_path))
    for field, name in (("daily", "train"), ("future", "test"), ("store", "store"), ("trend_raw", "googletrend")):
        cols = files[name].columns
        a = sorted(map(repr, getattr(read, field).select(*cols).collect()))
        assert a == sorted(map(repr, files[name].collect())), name
    assert load_dataset(read, "train").count() == 300


def test_engineered_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2001, 1, 2), 3.5)], "Store int, Date date, x double")
    sinks.write_engineered(df, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).select(df.columns).collect() == df.collect()


def test_trend_prefix_is_a_parameter(spark):
    raw = spark.createDataFrame([("Trend_DE", "2001-01-07 - 2001-01-13", 5), ("Trend_DE_BE", "2001-01-07 - 2001-01-13", 7)],
                                "file string, week string, trend int")
    per_state, national = readers.parse_trend(raw)
    assert [(r.State, r.TrendState) for r in per_state.collect()] == [("BE", 7)] and national.first().TrendDE == 5
    other = raw.withColumn("file", F.regexp_replace("file", "Trend_DE", "x-"))
    assert readers.parse_trend(other, "^x-_?")[1].first().TrendDE == 5


def test_easter_of_every_year(spark):
    got = spark.range(1900, 2100).select("id", easter_sunday(F.col("id")).alias("d")).collect()
    assert all(r.d == easter(r.id) for r in got)


def test_comparison_rounding_keeps_large_and_small_numbers(spark):
    xs = [1e13, 12345678901.126, 3.0e17, -2.5, 1.23456789e-9, 0.0, 1234.56789012, None, float("nan")]
    got = [r.x for r in spark.createDataFrame([(x,) for x in xs], "x double").select(compared(F.col("x")).alias("x")).collect()]
    assert got[:7] == [1e13, 12345678901.13, 3.0e17, -2.5, 1.234568e-9, 0.0, 1234.56789] and got[7] is None and np.isnan(got[8])


def test_row_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(F.col("id").alias("Store"), F.lit(1).alias("Date"))
    a, b = (sorted(r.Store for r in sampling.sample_rows(d, 0.2).collect()) for d in (df.repartition(3), df.repartition(11)))
    assert a == b and 850 < len(a) < 1150 and sampling.sample_rows(df, 1.0).count() == 5000


def test_log_scale_metrics(spark):
    df = spark.createDataFrame([(float(np.log1p(100)), float(np.log1p(110))), (float(np.log1p(0)), float(np.log1p(5)))], "y double, p double")
    m = evaluate_log(df, "y", "p", "expm1_").first()
    assert m.expm1_rmspe == pytest.approx(0.1) and m.expm1_mae == pytest.approx(7.5)
    assert RmspeEvaluator("y", "p").evaluate(df) == pytest.approx(0.1)


def test_leakage_by_data(spark):
    df = spark.createDataFrame([(10.0, 10, float(np.log1p(10)), 3), (20.0, 20, float(np.log1p(20)), 20)], "Sales double, a int, b double, c int")
    assert {r.feature for r in profile.leakage_by_data(df, ["a", "b", "c"]).collect()} == {"a", "b"}


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch, spark):
    from shopcast import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.checkpoint_dir(Session())
