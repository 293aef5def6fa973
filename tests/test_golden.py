"""Golden arithmetic: published tables and closed forms checked against
brute-force computations."""

import math
import random

import numpy as np
import plain_series
import pytest
import pandas as pd
from pyspark.sql import functions as F

from shopcast.functions import stats
from shopcast.operators import series as K

# A published autocorrelation table of a 942-day national
# series (lags 0..21) and its Yule-Walker (n-k) partial autocorrelations.
ACF_942 = [1.0, -0.025176103526057206, -0.07077569512448408, 0.021329162930883033, -0.0565707816876444,
           -0.18616714072379725, -0.180740357313728, 0.5466234676101059, -0.1910444813964306,
           -0.22554645676659293, -0.059308037905149505, -0.021950886553999356, -0.1198824789467869,
           -0.043404357791147034, 0.7316294423644626, -0.05594999965337603, -0.09809147743062867,
           -0.012026942817179495, -0.037615979105360686, -0.15719665300929153, -0.1563968165552125,
           0.5875987847755751]
PACF_942 = [1.0, -0.025202858152546102, -0.07160694936166492, 0.017779462269653195, -0.06122993492584836,
            -0.18919364612773257, -0.21186220371713127, 0.5518535659780169, -0.3181893521433154,
            -0.2826478581366845, -0.16228680228162382, 0.09745737949637284, 0.02433581050262202,
            0.06604915436561307, 0.5058415956812935, -0.05941060265811902, -0.06202791927533999,
            -0.12968770065525545, 0.006597618186685062, 0.019627993465889677, -0.04703288912632685,
            0.24487207609872838]


def test_pacf_from_published_acf(spark):
    n = 942
    rows = [(k, v, n) for k, v in enumerate(ACF_942)]
    df = spark.createDataFrame(rows, "lag int, acf double, n long")
    got = {r.lag: r.pacf for r in K.pacf(df).collect()}
    assert max(abs(got[k] - PACF_942[k]) for k in range(22)) < 1e-12


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(7)
    x = np.cumsum(rng.normal(size=200)) + 5 * np.sin(np.arange(200) * 2 * np.pi / 7)
    import datetime as dt
    rows = [(dt.date(2013, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(x)]
    s = spark.createDataFrame(rows, "Date date, value double")
    got = {r.lag: r.acf for r in K.acf(s, nlags=10).collect()}
    d = x - x.mean()
    exp = [float(np.sum(d[: len(d) - k] * d[k:]) / np.sum(d * d)) for k in range(11)]
    assert max(abs(got[k] - exp[k]) for k in range(11)) < 1e-10


def test_erfc_accuracy(spark):
    xs = [0.0, 0.1, 0.5, 1.0, 2.0, 3.5, -0.7, -2.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.e for r in df.select(stats.erfc(F.col("x")).alias("e")).collect()]
    for x, g in zip(xs, got):
        assert abs(g - math.erfc(x)) <= 1.2e-7 * math.erfc(x) + 1e-15


def test_chi2_yates_closed_form(spark):
    # contingency [[a,b],[c,d]] against the cell-by-cell Yates formula
    a, b, c, d = 120, 380, 40, 60
    n = a + b + c + d
    obs = np.array([[a, b], [c, d]], dtype=float)
    exp = np.outer(obs.sum(1), obs.sum(0)) / n
    chi_ref = float(np.sum((np.maximum(np.abs(obs - exp) - 0.5, 0)) ** 2 / exp))
    df = spark.createDataFrame([(a, b, c, d)], "a long, b long, c long, d long")
    chi, p = stats.chi2_yates_2x2(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    r = df.select(chi.alias("chi"), p.alias("p")).first()
    assert abs(r.chi - chi_ref) < 1e-9
    assert abs(r.p - math.erfc(math.sqrt(chi_ref / 2))) < 1e-6


def test_average_rank_global_and_grouped(spark):
    random.seed(3)
    vals = [(i % 3, float(random.randint(0, 20))) for i in range(300)]
    df = spark.createDataFrame(vals, "g int, x double").withColumn("id", F.monotonically_increasing_id())
    pdf = pd.DataFrame(vals, columns=["g", "x"])
    got = sorted(r.r for r in stats.average_rank(df, "x", "r", num_partitions=5).collect())
    assert got == sorted(pdf["x"].rank(method="average").tolist())
    got = sorted((r.g, r.r) for r in stats.average_rank(df, "x", "r", by=["g"]).collect())
    pdf["r"] = pdf.groupby("g")["x"].rank(method="average")
    assert got == sorted(zip(pdf["g"], pdf["r"]))


def test_spearman_hot_group_ties_and_nulls(spark):
    """Weighted pair ranks equal pandas' pairwise-complete Spearman; one
    group holds most rows (spans several range partitions), values repeat
    heavily, and some pairs have a missing side."""
    random.seed(5)
    rows = []
    for i in range(600):
        g = "hot" if i % 10 < 8 else f"g{i % 3}"
        x = float(random.randint(0, 6))
        y = None if i % 37 == 0 else float(random.randint(0, 30)) + (x if i % 2 else 0.0)
        rows.append((g, x if i % 53 else None, y))
    df = spark.createDataFrame(rows, "g string, x double, y double")
    pdf = pd.DataFrame(rows, columns=["g", "x", "y"]).dropna()

    def ref(d):
        return float(np.corrcoef(d["x"].rank(method="average"), d["y"].rank(method="average"))[0, 1])

    got = {r.g: (r.spearman, r.n) for r in stats.spearman(df, "x", "y", by=["g"]).collect()}
    for g, d in pdf.groupby("g"):
        assert got[g][0] == pytest.approx(ref(d), abs=1e-12) and got[g][1] == len(d)
    whole = stats.spearman(df, "x", "y").first()
    assert whole.spearman == pytest.approx(ref(pdf), abs=1e-12) and whole.n == len(pdf)
    ranked = stats.rank_table(spark.createDataFrame([("hot", float(v), 1) for v in range(40)], "g string, v double, _c int"),
                              "v", ["g"], num_partitions=4)
    assert sorted(r._rank for r in ranked.collect()) == [float(i) for i in range(1, 41)]


def test_exact_quantiles_match_numpy(spark):
    random.seed(9)
    rows = [("hot" if i % 4 else f"g{i % 3}", None if i % 41 == 0 else float(random.randint(0, 50)))
            for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = {r.g: r for r in stats.exact_quantiles(df, "x", probs, names, ["g"], count_col="n",
                                                 num_partitions=6).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "x"]).dropna()
    for g, d in pdf.groupby("g"):
        want = np.percentile(d["x"].to_numpy(), [100 * q for q in probs])
        assert [got[g][n] for n in names] == pytest.approx(list(want), abs=1e-9)
        assert got[g].n == len(d)
    whole = stats.exact_quantiles(df, "x", [0.5], ["m"]).collect()
    assert len(whole) == 1 and whole[0].m == pytest.approx(float(np.median(pdf["x"])))
    empty = stats.exact_quantiles(df.filter("x > 1000"), "x", [0.5], ["m"]).collect()
    assert len(empty) == 1 and empty[0].m is None
    assert stats.column_medians(df.withColumn("y", F.col("x") * 2), ["x", "y"]) == {
        "x": float(np.median(pdf["x"])), "y": float(np.median(pdf["x"] * 2))}


def test_mann_whitney_against_brute_force(spark):
    random.seed(11)
    a = [round(random.uniform(0, 1), 2) for _ in range(30)]
    b = [round(random.uniform(0.1, 1.1), 2) for _ in range(25)]
    df = spark.createDataFrame([("A", x) for x in a] + [("B", x) for x in b], "seg string, x double")
    r = stats.mann_whitney(df, "x", "seg", "A", "B").first()
    u1 = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in a for y in b)
    assert abs(r.u_statistic - u1) < 1e-9
    allv = pd.Series(a + b)
    ties = allv.value_counts()
    n1, n2 = len(a), len(b)
    n = n1 + n2
    tie = float(((ties ** 3) - ties).sum())
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - tie / (n * (n - 1))))
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sigma
    assert abs(r.p_value - min(math.erfc(z / math.sqrt(2)), 1.0)) < 1e-6


def test_adf_pvalue_published_point(spark):
    # the published national-series statistic -4.76 has p ~ 6.4e-5
    stats_ = [-4.76, -30.0, 3.0, -1.61, -1.0, 0.5, -2.9]
    got = spark.createDataFrame([(x,) for x in stats_], "x double").select("x", K.adf_pvalue(F.col("x")).alias("p")).collect()
    assert abs(got[0].p - 6.4e-5) < 0.2e-5
    assert all(abs(r.p - plain_series.pvalue(r.x)) < 1e-12 for r in got)


def test_adf_and_pacf_equal_plain_versions(spark):
    rng = np.random.default_rng(0)
    series = {"noise": rng.normal(size=400), "walk": np.cumsum(rng.normal(size=400)) + 1e4, "short": rng.normal(size=9),
              "sales": np.round(np.abs(rng.normal(5e4, 2e4, 730)) + 2e4 * np.sin(np.arange(730) / 7 * 2 * np.pi)), "six": rng.normal(size=6)}
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    s = spark.createDataFrame(rows, "id string, t int, value double").repartition(5)
    got = {r.id: r for r in K.adf(s, ["id"], order="t").collect()}
    for k, x in series.items():
        stat, p, lags, nobs = plain_series.adf(x)
        assert got[k].statistic == pytest.approx(stat, rel=1e-7) and got[k].p_value == pytest.approx(p, rel=1e-6, abs=1e-12)
        assert (got[k].used_lag, got[k].nobs, got[k].is_stationary) == (lags, nobs, int(p < 0.05))
    assert got["noise"].is_stationary == 1 and got["walk"].is_stationary == 0
    one = K.adf(s.where("id = 'sales'").drop("id"), order="t").first()
    assert one.statistic == got["sales"].statistic and "_series" not in one.asDict()
    acf = K.acf(s, ["id"], order="t", nlags=12)
    parts = {(r.id, r.lag): r.pacf for r in K.pacf(acf, ["id"]).collect()}
    for k in ("noise", "walk", "sales"):
        rho = [r.acf * r.n / (r.n - r.lag) for r in sorted(acf.where(F.col("id") == k).collect(), key=lambda r: r.lag)]
        assert [parts[(k, i)] for i in range(13)] == pytest.approx(plain_series.durbin_levinson(rho), abs=1e-9)


def test_adf_moments_follow_from_sums_of_lag_zero(spark):
    # integers: exact, whatever the order of summation
    rng = np.random.default_rng(4)
    x = rng.integers(0, 300_000, 90).astype(float)
    d = np.diff(x)
    df = spark.createDataFrame([(lags, x.tolist(), d.tolist()) for lags in (0, 1, 7, 19)], "lags int, x array<double>, d array<double>")
    got = df.select("lags", K._half_moments(F.col("x"), F.col("d"), F.col("lags")).alias("a"),
                    K._half_moments(F.col("x"), F.col("d"), F.col("lags"), level_last=True).alias("b")).collect()
    for r in got:
        y, z, _ = plain_series.design(x, r.lags)
        for half, cols in ((r.a, np.column_stack([z, y])), (r.b, np.column_stack([z[:, :1], z[:, 2:], z[:, 1:2], y]))):
            m = cols.T @ cols
            assert [list(row) for row in half] == [m[i, i:].tolist() for i in range(len(m))]


def test_series_run_without_python_workers(spark):
    s = spark.createDataFrame([("a", i, float(i * i % 17)) for i in range(60)], "id string, t int, value double")
    for df in (K.adf(s, ["id"], order="t"), K.pacf(K.acf(s, ["id"], order="t"), ["id"])):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_q05_log_shares_from_printed_means():
    # printed lifts (percent) of a published promo table -> shares 55 % / 43 %
    lift_sales, lift_cust, lift_basket = 38.77, 19.75, 15.26
    share_c = 100 * math.log1p(lift_cust / 100) / math.log1p(lift_sales / 100)
    share_b = 100 * math.log1p(lift_basket / 100) / math.log1p(lift_sales / 100)
    assert round(share_c) == 55 and round(share_b) == 43
