"""Properties on the derived panel (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopcast.operators import clean as C
from shopcast.operators import sampling as S
from shopcast.operators import series as K
from shopcast.operators.joins import merge_store
from shopcast.plans import questions as Q
from shopcast.plans.context import build_context


def ctx(spark):
    return build_context(spark, SF_SMALL)


def test_panel_checksums(spark):
    c = ctx(spark)
    r = c.raw.agg(F.count("*").alias("n"), F.sum("Sales").alias("s"), F.sum("Customers").alias("c"),
                  F.sum("Open").alias("o")).first()
    assert (r.n, r.s, r.c, r.o) == (24990, 301270818, 5995, 5537)
    assert c.clean.count() == 5334


def test_store_join_preserves_rows(spark):
    c = ctx(spark)
    assert merge_store(c.inputs.daily, c.inputs.store).count() == c.inputs.daily.count()


def test_store_join_guard(spark):
    c = ctx(spark)
    dup = c.inputs.store.unionByName(c.inputs.store)
    try:
        merge_store(c.inputs.daily, dup)
    except ValueError:
        pass
    else:
        raise AssertionError("duplicate store rows must be rejected")


def test_clean_idempotent_on_panel(spark):
    c = ctx(spark)
    once = C.clean_missing(c.raw)
    twice = C.clean_missing(once)
    cols = once.columns
    assert once.select(cols).exceptAll(twice.select(cols)).count() == 0


def test_split_is_partition(spark):
    c = ctx(spark)
    s = S.chrono_split(c.clean)
    assert s.count() == c.clean.count()
    tr_max = s.filter(F.col("split") == "train").agg(F.max("Date")).first()[0]
    va_min = s.filter(F.col("split") == "valid").agg(F.min("Date")).first()[0]
    assert tr_max < va_min


def test_quartile_shares_sum_to_100(spark):
    c = ctx(spark)
    tot = Q.q06_quartiles(c).agg(F.sum("share_of_total_incremental")).first()[0]
    assert abs(tot - 100.0) < 1e-9


def test_windows_targets_ordered(spark):
    c = ctx(spark)
    w = K.windows(K.store_series(c.clean), ["Store"])
    bad = (w.groupBy("Store").agg(F.max(F.when(F.col("split") == "train", F.col("Date"))).alias("t"),
                                  F.min(F.when(F.col("split") == "valid", F.col("Date"))).alias("v"))
           .filter(F.col("t") >= F.col("v")).count())
    assert bad == 0


def test_inverse_scale_is_identity(spark):
    c = ctx(spark)
    x = K.scaled_positions(K.store_series(c.clean), ["Store"])
    err = x.select(F.max(F.abs(K.inverse_scale(F.col("scaled"), F.col("lo"), F.col("hi")) - F.col("value")))).first()[0]
    assert err < 1e-6


def test_outlier_remove_drops_flagged(spark):
    c = ctx(spark)
    t = C.trading_days(C.clean_missing(c.raw))
    flagged = C.handle_outliers(t, "flag").filter("IsSalesOutlier = 1").count()
    assert C.handle_outliers(t, "remove").count() == t.count() - flagged
