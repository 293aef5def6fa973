"""Operator-level catalogue queries (sources, joins, cleaning, features,
splits, metrics, forecast rules). Each takes a PanelContext and returns a
DataFrame over the whole derived panel."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.functions.calendar import week_start_sunday
from shopcast.functions.stats import with_scalars
from shopcast.operators import clean as C
from shopcast.operators import features as FE
from shopcast.operators import forecast as FC
from shopcast.operators import metrics as M
from shopcast.operators import profile as PR
from shopcast.operators import sampling as S
from shopcast.operators.joins import merge_store
from shopcast.plans.context import PanelContext
from shopcast.session import checkpoint_dir
from shopcast.sources.readers import classified_lines, parse_trend, state_lookup
from shopcast.sources.schemas import DAILY
from shopcast.sources.sinks import write_clustered

GAP = ["Mean_TemperatureC", "Precipitationmm", "TrendState", "TrendDE"]
SAMPLE_STORES = 60


def panel_join(ctx: PanelContext) -> DataFrame:                          # J01
    return merge_store(ctx.inputs.daily, ctx.inputs.store)


def state_lookup_q(ctx: PanelContext) -> DataFrame:                      # S04/J02
    return state_lookup(ctx.inputs.store_states, ctx.inputs.state_names)


def weather_join(ctx: PanelContext) -> DataFrame:                        # J03
    return ctx.raw.select("Store", "Date", "State", "Mean_TemperatureC", "Precipitationmm")


def trend_week_join(ctx: PanelContext) -> DataFrame:                     # J04/J05
    return ctx.raw.select("Store", "Date", week_start_sunday(F.col("Date")).alias("WeekStart"),
                          "TrendState", "TrendDE")


def trend_parse(ctx: PanelContext) -> DataFrame:                         # S06
    per_state, national = parse_trend(ctx.inputs.trend_raw)
    return (per_state.select(F.lit("state").alias("kind"), "State", "WeekStart",
                             F.col("TrendState").alias("trend"))
            .unionByName(national.select(F.lit("national").alias("kind"), F.lit("").alias("State"),
                                         "WeekStart", F.col("TrendDE").alias("trend"))))


def date_spine(ctx: PanelContext) -> DataFrame:                          # S12
    start = ctx.inputs.daily.agg(F.date_add(F.max("Date"), 1).alias("_start"))
    stores = with_scalars(ctx.inputs.store.select("Store"), start)
    return FC.request_template(stores, F.col("_start"))


def profile(ctx: PanelContext) -> DataFrame:                             # S15
    return PR.frame_profile(ctx.raw)


def missing_report(ctx: PanelContext) -> DataFrame:                      # A10
    return PR.missing_value_report(ctx.raw)


def outlier_report(ctx: PanelContext) -> DataFrame:                      # A11
    return PR.outlier_report(ctx.clean)


def csv_rejects(ctx: PanelContext) -> DataFrame:                         # S01 with malformed rows
    """The daily table as text lines, some of them spoilt by a rule over store
    and day, read again: what becomes of each line (good rows by their key)."""
    d = ctx.inputs.daily
    day = (F.datediff("Date", F.lit(ctx.epoch).cast("date")) + F.col("Store")) % 101
    cells = {c: F.col(c).cast("string") for c in DAILY.fieldNames()}
    cells["Date"] = F.when(day == 7, F.lit("31.02.")).otherwise(cells["Date"])
    cells["Sales"] = F.when(day == 11, F.lit("n/a")).when(day == 13, F.lit("1e99")).otherwise(cells["Sales"])
    line = F.concat_ws(",", *[cells[c] for c in DAILY.fieldNames()])
    line = F.when(day == 17, F.concat_ws(",", cells["Store"], cells["Date"])).otherwise(line)
    path = os.path.join(checkpoint_dir(ctx.spark), f"daily-{uuid.uuid4().hex[:8]}")
    d.select(line.alias("value")).write.text(path)
    # Good rows and rejects in one pass over the lines.
    lines = classified_lines(ctx.spark, path, DAILY, header=DAILY.fieldNames())
    good = F.col("_why").isNull()
    return lines.select(F.coalesce("_why", F.lit("good")).alias("reason"), *[F.when(good, F.col(c)).alias(c) for c in ("Store", "Date", "Sales")],
                        F.when(~good, F.col("_line")).alias("line"))


def clustered_outliers(ctx: PanelContext) -> DataFrame:                  # S08 clustered by store, C02 on it
    """Outlier flags from a table clustered by store: fences and their join
    need no exchange of the facts."""
    path = os.path.join(checkpoint_dir(ctx.spark), f"clustered-{uuid.uuid4().hex[:8]}")
    facts = write_clustered(_trading(ctx).select("Store", "Date", "Sales", "Open"), path)
    return C.handle_outliers(facts).select("Store", "Date", "Sales", "IsSalesOutlier")


def _requests(ctx: PanelContext) -> DataFrame:
    e = ctx.test
    date_txt = F.when(F.col("Open").isNull(), F.lit("not-a-date")).otherwise(F.date_format("Date", "yyyy-MM-dd"))
    by_store = e.select(F.concat(F.lit("store-"), F.col("Store").cast("string")).alias("request_id"),
                        "Store", date_txt.alias("Date"))
    by_type = e.select(F.concat(F.lit("type-"), F.col("StoreType")).alias("request_id"),
                       "Store", date_txt.alias("Date"))
    return by_store.unionByName(by_type)


def request_validation(ctx: PanelContext) -> DataFrame:                  # S11
    """Rules per request; one request per state was made without rows."""
    made = _requests(ctx).select("request_id").unionByName(
        ctx.inputs.state_names.select(F.concat(F.lit("state-"), F.col("State")).alias("request_id")))
    return FC.validate_requests(_requests(ctx), ids=made)


def forecast_requests(ctx: PanelContext) -> DataFrame:                   # S11/J11
    """Every request row, accepted or rejected with its reason; each request's
    last rows ask for a store that does not exist."""
    req = _requests(ctx)
    beyond = F.max("Store").alias("_top")
    unknown = with_scalars(req, req.agg(beyond)).withColumn("Store", F.when(
        F.col("Store") % 5 == 0, F.col("Store") + F.col("_top")).otherwise(F.col("Store"))).drop("_top")
    out = FC.screen_requests(unknown, ctx.inputs.store)
    return out.select("request_id", "Store", "Date", F.coalesce("reason", F.lit("accepted")).alias("verdict"))


def clean_missing(ctx: PanelContext) -> DataFrame:                       # C01
    return C.clean_missing(ctx.raw)


def fill_forward_back(ctx: PanelContext) -> DataFrame:                   # W01/W02
    return C.fill_forward_back(ctx.raw.select("Store", "Date", *GAP), GAP, scope="store")


def fill_frame_scope(ctx: PanelContext) -> DataFrame:                    # W02 (frame)
    return C.fill_forward_back(ctx.raw.select("Store", "Date", *GAP), GAP, scope="frame")


def _trading(ctx: PanelContext) -> DataFrame:
    return C.trading_days(C.clean_missing(ctx.raw))


def trading_days(ctx: PanelContext) -> DataFrame:                        # P03
    return _trading(ctx).select("Store", "Date", "Sales", "Customers")


def chrono_split(ctx: PanelContext) -> DataFrame:                        # P04
    s = S.chrono_split(_trading(ctx).select("Store", "Date"))
    return s.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                  F.min("Date").alias("first_date"), F.max("Date").alias("last_date"),
                                  F.countDistinct("Store").cast("bigint").alias("stores"))


def store_sample(ctx: PanelContext) -> DataFrame:                        # P05/P07
    t = _trading(ctx)
    kept = S.keep_stores(t, S.sample_stores(ctx.raw, SAMPLE_STORES))
    return kept.groupBy("Store").agg(F.count(F.lit(1)).cast("bigint").alias("trading_days"))


def outlier_fence(ctx: PanelContext) -> DataFrame:                       # A06
    return C.outlier_fences(_trading(ctx))


def _outliers(ctx: PanelContext, strategy: str) -> DataFrame:
    return C.handle_outliers(_trading(ctx), strategy=strategy)


def outlier_flag(ctx: PanelContext) -> DataFrame:                        # C02 flag
    return _outliers(ctx, "flag").select("Store", "Date", "Sales", "IsSalesOutlier")


def outlier_cap(ctx: PanelContext) -> DataFrame:                         # C02 cap
    return _outliers(ctx, "cap").select("Store", "Date", "Sales", "IsSalesOutlier")


def outlier_remove(ctx: PanelContext) -> DataFrame:                      # C02 remove
    return _outliers(ctx, "remove").select("Store", "Date", "Sales")


DATE_COLS = ["Year", "Month", "Day", "WeekOfYear", "DayOfYear", "Quarter", "DayOfWeek", "IsWeekend", "IsSunday",
             "DaysInMonth", "IsMonthStart", "IsMidMonth", "IsMonthEnd", "MonthPhase", "DaysToMonthEnd",
             "IsPayWeek", "MonthSin", "MonthCos", "DayOfWeekSin", "DayOfWeekCos", "DayOfYearSin",
             "DayOfYearCos", "TimeIndex", "IsDecember", "DaysToChristmas", "IsChristmasRunUp"]
COMP_COLS = ["CompetitionOpenMonths", "CompetitionIsNew", "CompetitionNotYetOpen", "CompetitionDistanceLog",
             "IsCityCentre"]
PROMO2_COLS = ["IsPromo2Active", "Promo2ActiveWeeks", "PromoAndPromo2", "AnyPromo"]


def date_features(ctx: PanelContext) -> DataFrame:                       # C04
    return ctx.clean.select("Store", "Date", *DATE_COLS)


def holiday_calendar(ctx: PanelContext) -> DataFrame:                    # U01
    return ctx.calendar


def holiday_distance(ctx: PanelContext) -> DataFrame:                    # J06/C05
    return FE.holiday_distance(ctx.raw.select("Date"), ctx.calendar)


def holiday_flags(ctx: PanelContext) -> DataFrame:                       # F08
    return ctx.clean.select("Store", "Date", *FE.HOLIDAY_COLUMNS)


def competition_features(ctx: PanelContext) -> DataFrame:                # F09-F10
    return ctx.clean.select("Store", "Date", *COMP_COLS)


def promo2_active(ctx: PanelContext) -> DataFrame:                       # F11-F14
    return ctx.clean.select("Store", "Date", *PROMO2_COLS)


def _aggs(ctx: PanelContext) -> FE.StoreAggregates:
    return FE.fit_store_aggregates(ctx.clean)


def store_stats(ctx: PanelContext) -> DataFrame:                         # C07
    return _aggs(ctx).stores.select("Store", *FE.STORE_STAT_COLUMNS)


def _keyed(ctx: PanelContext, col: str, key: str, name: str) -> DataFrame:
    return _aggs(ctx).stores.select("Store", F.explode(col).alias(key, name))


def store_dow_mean(ctx: PanelContext) -> DataFrame:
    return _keyed(ctx, "_dow", "DayOfWeek", "StoreDowMeanSales")


def store_promo_mean(ctx: PanelContext) -> DataFrame:
    return _keyed(ctx, "_promo", "Promo", "StorePromoMeanSales")


def store_month_mean(ctx: PanelContext) -> DataFrame:
    return _keyed(ctx, "_month", "Month", "StoreMonthMeanSales")


def store_aggregates_joined(ctx: PanelContext) -> DataFrame:             # J07/F16
    return ctx.clean.select("Store", "Date", *FE.STORE_LOOKUP_COLUMNS, "DowSalesIndex", "MonthSalesIndex")


def store_leave_one_out(ctx: PanelContext) -> DataFrame:                 # C07 on the training fold
    """Store aggregates of every training row without the row itself."""
    t = S.chrono_split(ctx.clean)
    train = t.filter(F.col("split") == "train").drop("split")
    out = FE.leave_one_out(train, FE.fit_store_aggregates(train))
    # Two ways of summing squares differ in the last digits of a double.
    cents = F.floor(F.col("StoreStdSales") * 100.0 + 0.5).cast("double") / 100.0
    return out.withColumn("StoreStdSales", cents).select("Store", "Date", *FE.LEAVE_ONE_OUT_COLUMNS)


def _split_naive(ctx: PanelContext):
    t = S.chrono_split(ctx.clean)
    train, valid = t.filter(F.col("split") == "train"), t.filter(F.col("split") == "valid")
    aggs = FE.fit_store_aggregates(train)
    return train, valid, aggs


def metrics_bundle(ctx: PanelContext) -> DataFrame:                      # A21
    _, valid, aggs = _split_naive(ctx)
    return M.evaluate(FC.naive_forecast(valid, aggs), "Sales", "PredictedSales")


def interval_coverage(ctx: PanelContext) -> DataFrame:                   # M14
    train, valid, _ = _split_naive(ctx)
    iv = FC.empirical_interval(train)
    return M.interval_coverage(valid.join(iv, ["Store", "DayOfWeek"], "left"), "Sales", "lower", "upper")


def _future_scored(ctx: PanelContext) -> DataFrame:
    e = C.clean_missing(ctx.test).withColumn("Month", F.month("Date"))
    return FC.naive_forecast(e, _aggs(ctx))


def customers_estimate(ctx: PanelContext) -> DataFrame:                  # C09
    return FC.customers_estimate(_future_scored(ctx)).select("Id", "Store", "Date", "PredictedSales",
                                                             "PredictedCustomers")


def closed_rule(ctx: PanelContext) -> DataFrame:                         # C10
    f = FC.customers_estimate(_future_scored(ctx))
    return FC.closed_rule(f).select("Id", "Store", "Date", "Open", "PredictedSales", "PredictedCustomers")


OPERATOR_QUERIES = {
    "panel_join": panel_join, "state_lookup": state_lookup_q, "weather_join": weather_join,
    "trend_week_join": trend_week_join, "trend_parse": trend_parse, "date_spine": date_spine,
    "forecast_requests": forecast_requests,
    "profile": profile, "missing_report": missing_report, "outlier_report": outlier_report,
    "request_validation": request_validation, "clean_missing": clean_missing,
    "fill_forward_back": fill_forward_back, "fill_frame_scope": fill_frame_scope,
    "trading_days": trading_days, "chrono_split": chrono_split, "store_sample": store_sample,
    "outlier_fence": outlier_fence, "outlier_flag": outlier_flag, "outlier_cap": outlier_cap,
    "outlier_remove": outlier_remove, "date_features": date_features, "holiday_calendar": holiday_calendar,
    "holiday_distance": holiday_distance, "holiday_flags": holiday_flags,
    "competition_features": competition_features, "promo2_active": promo2_active,
    "store_stats": store_stats, "store_dow_mean": store_dow_mean, "store_promo_mean": store_promo_mean,
    "store_month_mean": store_month_mean, "store_aggregates_joined": store_aggregates_joined,
    "store_leave_one_out": store_leave_one_out, "csv_rejects": csv_rejects, "clustered_outliers": clustered_outliers,
    "metrics_bundle": metrics_bundle, "interval_coverage": interval_coverage,
    "customers_estimate": customers_estimate, "closed_rule": closed_rule,
}


# --- time series (K01-K06, W05, W09) ----------------------------------------

from shopcast.operators import series as K  # noqa: E402


def series_national(ctx: PanelContext) -> DataFrame:                     # K01
    return K.national_series(ctx.clean)


def series_diff(ctx: PanelContext) -> DataFrame:                         # W05
    return K.first_difference(K.national_series(ctx.clean))


def acf_national(ctx: PanelContext) -> DataFrame:                        # K04
    return K.acf(K.national_series(ctx.clean), nlags=21)


def pacf_national(ctx: PanelContext) -> DataFrame:                       # K05
    return K.pacf(K.acf(K.national_series(ctx.clean), nlags=21))


def adf_national(ctx: PanelContext) -> DataFrame:                        # K02
    return K.adf(K.national_series(ctx.clean))


def adf_by_store(ctx: PanelContext) -> DataFrame:                        # K02 per store
    return K.adf(K.store_series(ctx.clean), by=["Store"])


def series_diff_if_needed(ctx: PanelContext) -> DataFrame:               # K03
    s = K.store_series(ctx.clean)
    return K.difference_if_needed(s, K.adf(s, by=["Store"]), by=["Store"])


def minmax_scaled(ctx: PanelContext) -> DataFrame:                       # W09
    x = K.scaled_positions(K.store_series(ctx.clean), ["Store"])
    return x.select("Store", "Date", "split", "scaled",
                    K.inverse_scale(F.col("scaled"), F.col("lo"), F.col("hi")).alias("inverse"), "lo", "hi")


def windows(ctx: PanelContext) -> DataFrame:                             # K06
    return K.windows(K.store_series(ctx.clean), ["Store"])


OPERATOR_QUERIES.update({
    "series_national": series_national, "series_diff": series_diff, "acf": acf_national,
    "pacf": pacf_national, "adf_national": adf_national, "adf_by_store": adf_by_store,
    "series_diff_if_needed": series_diff_if_needed, "minmax_scaled": minmax_scaled, "windows": windows,
})
