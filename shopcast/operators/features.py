"""Feature operators C04-C08 and the holiday calendar U01 / as-of J06.

Scale:
* C04/C06 are pure projections (one codegen stage, no shuffle).
* J06 (holiday distance) runs on the *date dimension* only: distinct dates
  of the fact plus the holiday calendar, at most one row per calendar day,
  so its unpartitioned as-of window and the broadcast back to the fact are
  bounded by the calendar span, not by data volume.
* C07 fits per-store state as ONE row per store (means by weekday, promo
  and month are folded into small maps), so transform is a single join on
  Store instead of four.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcast.functions.calendar import DEFAULT_EPOCH, date_feature_columns
from shopcast.functions.promo import competition_promo_columns
from shopcast.functions.stats import column_medians
from shopcast.session import materialize

NO_HOLIDAY_DAYS = 999
HOLIDAY_COLUMNS = ["DaysToNextHoliday", "DaysAfterLastHoliday", "IsStateHoliday",
                   "IsHolidayWeek", "IsDayBeforeHoliday", "IsDayAfterHoliday"]


def date_features(df: DataFrame, epoch: str = DEFAULT_EPOCH) -> DataFrame:     # C04
    new = date_feature_columns(F.col("Date"), epoch)
    keep = [c for c in df.columns if c not in new]
    return df.select(*keep, *[v.alias(k) for k, v in new.items()])


def is_holiday(state_holiday) -> "F.Column":
    return F.coalesce(state_holiday.cast("string"), F.lit("0")) != "0"


def holiday_calendar(*frames: DataFrame) -> DataFrame:                         # U01
    """Distinct dates flagged as a state holiday in any of the frames."""
    # Distinct for each frame: left joins that bring no column of it are dropped.
    parts = [f.filter(is_holiday(F.col("StateHoliday"))).select(F.col("Date").alias("Date")).distinct()
             for f in frames if "StateHoliday" in f.columns and "Date" in f.columns]
    if not parts:
        raise ValueError("no frame carries StateHoliday and Date")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def holiday_distance(dates: DataFrame, calendar: DataFrame) -> DataFrame:       # J06
    """For each distinct Date: days to the next holiday on or after it and
    days since the last holiday strictly before it (999 if none).

    As-of in both directions over the date dimension: union of dates and
    holidays, ordered by day with date rows before holiday rows of the
    same day, then first/last non-null holiday over following/preceding
    rows.
    """
    d = dates.select("Date").distinct().select("Date", F.lit(0).alias("_k"),
                                               F.lit(None).cast("date").alias("_h"))
    h = calendar.select("Date", F.lit(1).alias("_k"), F.col("Date").alias("_h"))
    u = d.unionByName(h)
    # Unpartitioned window: rows are calendar days (bounded), not facts.
    order = Window.orderBy("Date", "_k")
    nxt = F.first("_h", True).over(order.rowsBetween(0, Window.unboundedFollowing))
    prv = F.last("_h", True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (u.select("Date", "_k", nxt.alias("_next"), prv.alias("_prev"))
            .filter(F.col("_k") == 0)
            .select("Date",
                    F.least(F.greatest(F.coalesce(F.datediff("_next", "Date"), F.lit(NO_HOLIDAY_DAYS)),
                                       F.lit(0)), F.lit(NO_HOLIDAY_DAYS)).cast("int")
                    .alias("DaysToNextHoliday"),
                    F.least(F.greatest(F.coalesce(F.datediff("Date", "_prev"), F.lit(NO_HOLIDAY_DAYS)),
                                       F.lit(0)), F.lit(NO_HOLIDAY_DAYS)).cast("int")
                    .alias("DaysAfterLastHoliday")))


def holiday_features(df: DataFrame, calendar: DataFrame | None = None) -> DataFrame:   # C05
    """DaysToNextHoliday, DaysAfterLastHoliday and the four holiday flags.

    Without a calendar, it is learned from ``df`` itself.
    """
    if calendar is None:
        calendar = holiday_calendar(df)
    base = df.drop(*[c for c in HOLIDAY_COLUMNS if c in df.columns])
    dist = holiday_distance(base.select("Date"), calendar)
    return holiday_flags(base.join(F.broadcast(dist), "Date", "left"), base)  # one row per calendar day


def holiday_flags(out: DataFrame, base: DataFrame) -> DataFrame:
    """The columns of ``base`` with both distances and the four flags."""
    nxt, prv = F.col("DaysToNextHoliday"), F.col("DaysAfterLastHoliday")
    return out.select(
        *base.columns, nxt, prv,
        is_holiday(F.col("StateHoliday")).cast("int").alias("IsStateHoliday"),
        ((nxt <= 3) | (prv <= 3)).cast("int").alias("IsHolidayWeek"),
        (nxt == 1).cast("int").alias("IsDayBeforeHoliday"),
        (prv == 1).cast("int").alias("IsDayAfterHoliday"),
    )


def request_holidays(df: DataFrame, request: str = "request_id") -> DataFrame:
    """Holiday distances of request rows that already have those of the common
    calendar: the holidays that a request flags count for its own rows only.
    A request is one window partition; validation bounds its rows."""
    base = df.drop(*[c for c in HOLIDAY_COLUMNS if c in df.columns])
    day = F.datediff("Date", F.lit("1970-01-01").cast("date"))
    own = F.when(is_holiday(F.col("StateHoliday")), F.col("_day"))
    w = Window.partitionBy(request).orderBy("_day")
    out = df.withColumn("_day", day)
    nxt = F.min(own).over(w.rangeBetween(0, Window.unboundedFollowing)) - F.col("_day")
    prv = F.col("_day") - F.max(own).over(w.rangeBetween(Window.unboundedPreceding, -1))
    out = out.withColumns({"DaysToNextHoliday": F.least("DaysToNextHoliday", nxt.cast("int")),
                           "DaysAfterLastHoliday": F.least("DaysAfterLastHoliday", prv.cast("int"))})
    return holiday_flags(out, base)


def competition_promo_features(df: DataFrame) -> DataFrame:                     # C06
    need = ["Year", "Month", "Date", "Promo", "CompetitionOpenSinceYear", "CompetitionOpenSinceMonth",
            "CompetitionDistance", "PromoInterval", "Promo2", "Promo2SinceYear", "Promo2SinceWeek"]
    new = competition_promo_columns({c: F.col(c) for c in need})
    keep = [c for c in df.columns if c not in new]
    return df.select(*keep, *[v.alias(k) for k, v in new.items()])


STORE_STAT_COLUMNS = ["StoreMeanSales", "StoreMedianSales", "StoreStdSales", "StoreMaxSales",
                      "StoreOpenDays", "StoreMeanCustomers", "StoreSalesPerCustomer"]
STORE_LOOKUP_COLUMNS = ["StoreDowMeanSales", "StorePromoMeanSales", "StoreMonthMeanSales"]


@dataclass
class StoreAggregates:
    """Fitted per-store state (C07): one row per store plus fallbacks."""

    stores: DataFrame          # Store, stats..., dow_map, promo_map, month_map
    fallbacks: dict            # column -> value for stores unseen at fit

    def transform(self, df: DataFrame) -> DataFrame:
        s = self.stores
        out = df.drop(*[c for c in STORE_STAT_COLUMNS + STORE_LOOKUP_COLUMNS if c in df.columns]) \
            .join(s, "Store", "left")
        fb = self.fallbacks
        stat_cols = [c for c in STORE_STAT_COLUMNS if c in s.columns]
        cols = {c: F.coalesce(F.col(c), F.lit(fb[c])) for c in stat_cols}
        cols["StoreDowMeanSales"] = F.coalesce(F.try_element_at(F.col("_dow"), F.col("DayOfWeek")),
                                               F.lit(fb["StoreDowMeanSales"]))
        cols["StorePromoMeanSales"] = F.coalesce(F.try_element_at(F.col("_promo"), F.col("Promo")),
                                                 F.lit(fb["StorePromoMeanSales"]))
        cols["StoreMonthMeanSales"] = F.coalesce(F.try_element_at(F.col("_month"), F.col("Month")),
                                                 F.lit(fb["StoreMonthMeanSales"]))
        mean = F.nullif(cols["StoreMeanSales"], F.lit(0.0))
        cols["DowSalesIndex"] = F.coalesce(cols["StoreDowMeanSales"] / mean, F.lit(1.0))
        cols["MonthSalesIndex"] = F.coalesce(cols["StoreMonthMeanSales"] / mean, F.lit(1.0))
        keep = [c for c in df.columns if c not in cols]
        return out.select(*keep, *[v.alias(k) for k, v in cols.items()])


def fit_store_aggregates(df: DataFrame, include_customers: bool = True) -> StoreAggregates:  # C07
    """Per-store history on open rows with Sales > 0."""
    rows = df.filter((F.col("Open") == 1) & (F.col("Sales") > 0)) if "Open" in df.columns \
        else df.filter(F.col("Sales") > 0)
    with_cust = include_customers and "Customers" in df.columns
    stats = [F.avg("Sales").alias("StoreMeanSales"),
             F.median("Sales").alias("StoreMedianSales"),
             F.coalesce(F.stddev_samp("Sales"), F.lit(0.0)).alias("StoreStdSales"),
             F.max("Sales").cast("double").alias("StoreMaxSales"),
             F.count(F.lit(1)).cast("double").alias("StoreOpenDays")]
    if with_cust:
        stats += [F.avg("Customers").alias("StoreMeanCustomers"),
                  (F.sum("Sales") / F.greatest(F.sum("Customers"), F.lit(1))).alias("StoreSalesPerCustomer")]
    if "Month" not in rows.columns:
        rows = rows.withColumn("Month", F.month("Date"))
    if "DayOfWeek" not in rows.columns:
        rows = rows.withColumn("DayOfWeek", F.weekday("Date") + 1)
    # The columns that are fitted on, written once: each aggregate reads these.
    rows = materialize(rows.select("Store", "DayOfWeek", "Promo", "Month", "Sales", *(["Customers"] if with_cust else [])), "store-rows")
    per_store = rows.groupBy("Store").agg(*stats)
    # One pass over the fact for all three lookups: at most 7 x 2 x 12 rows per store.
    cells = materialize(rows.groupBy("Store", "DayOfWeek", "Promo", "Month").agg(
        F.sum(F.col("Sales").cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n")), "store-cells")

    def keyed_means(key: str, name: str) -> DataFrame:
        m = cells.groupBy("Store", key).agg((F.sum("_s") / F.sum("_n")).alias("m"))
        return m.groupBy("Store").agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col("m"))))
                                      .alias(name))

    per_store = materialize(per_store, "store-stats")
    stores = (per_store.join(keyed_means("DayOfWeek", "_dow"), "Store", "left")
              .join(keyed_means("Promo", "_promo"), "Store", "left")
              .join(keyed_means("Month", "_month"), "Store", "left"))
    # Fallbacks for unseen stores, fixed at fit (one aggregate job, scalars only).
    g = rows.agg(F.avg("Sales").alias("mean"), F.stddev_samp("Sales").alias("std"),
                 (F.sum("Sales") / F.greatest(F.sum("Customers"), F.lit(1))).alias("ratio")
                 if with_cust else F.lit(None).alias("ratio")).first()
    # Exact medians over stores, ranked across partitions.
    s = column_medians(per_store, ["StoreOpenDays"] + (["StoreMeanCustomers"] if with_cust else []))
    gm = float(g["mean"]) if g["mean"] is not None else 0.0
    fb = {"StoreMeanSales": gm, "StoreMedianSales": gm, "StoreMaxSales": gm,
          "StoreStdSales": float(g["std"] or 0.0), "StoreOpenDays": float(s["StoreOpenDays"] or 0.0),
          "StoreDowMeanSales": gm, "StorePromoMeanSales": gm, "StoreMonthMeanSales": gm}
    if with_cust:
        fb["StoreMeanCustomers"] = float(s["StoreMeanCustomers"] or 0.0)
        fb["StoreSalesPerCustomer"] = float(g["ratio"] or 0.0)
    return StoreAggregates(stores=stores, fallbacks=fb)


LEAVE_ONE_OUT_COLUMNS = STORE_STAT_COLUMNS + STORE_LOOKUP_COLUMNS + ["DowSalesIndex", "MonthSalesIndex"]


def leave_one_out(df: DataFrame, aggs: StoreAggregates) -> DataFrame:            # C07 on its own training rows
    """The store aggregates of every training row over its store's other
    training rows (open, Sales > 0), so that a row's own sales are no part of
    its features; rows that were no training rows get the aggregates as fitted.
    ``aggs`` gives the fallbacks of stores without another row.

    One grouped pass per key set (map-side combined) and one join on Store:
    sums and counts leave a row out by subtraction, the maximum through the
    second largest value, the median through the neighbours of the middle: the
    k-th smallest of the others is the k-th of all if the row's value is above
    it, else the next one. A store's values are bounded by its days.
    """
    if "Month" not in df.columns:
        df = df.withColumn("Month", F.month("Date"))
    if "DayOfWeek" not in df.columns:
        df = df.withColumn("DayOfWeek", F.weekday("Date") + 1)
    is_open = (F.col("Open") == 1) if "Open" in df.columns else F.lit(True)
    used = F.coalesce(is_open & (F.col("Sales") > 0), F.lit(False))
    with_cust = "StoreMeanCustomers" in aggs.fallbacks and "Customers" in df.columns
    rows, x = df.filter(used), F.col("Sales").cast("double")
    cells = materialize(rows.groupBy("Store", "DayOfWeek", "Promo", "Month").agg(
        F.sum(x).alias("_s"), F.count(F.lit(1)).alias("_n")), "store-cells")

    def sums(key: str, name: str) -> DataFrame:
        m = cells.groupBy("Store", key).agg(F.sum("_s").alias("s"), F.sum("_n").alias("n"))
        return m.groupBy("Store").agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.struct("s", "n")))).alias(name))

    v, n = F.col("_v"), F.size("_v")
    low, high = ((n + F.lit(d)) / 2 for d in (0, 1))                    # middles of the n - 1 others, from 1
    stats = [F.sort_array(F.collect_list(x)).alias("_v"), F.sum(x).alias("_sum")]
    stats += [F.sum("Customers").alias("_cust"), F.count("Customers").alias("_custs")] if with_cust else []
    stores = rows.groupBy("Store").agg(*stats)
    # Deviations from the store's mean keep the sum of squares exact enough.
    mean = F.col("_sum") / n
    stores = stores.select("Store", n.cast("double").alias("_all"), "_sum", *[c for c in ("_cust", "_custs") if with_cust],
                           F.aggregate(v, F.lit(0.0), lambda acc, y: acc + (y - mean) * (y - mean)).alias("_dev"),
                           F.get(v, n - 1).alias("_top"), F.get(v, n - 2).alias("_second"),
                           *[F.get(v, (m.cast("int") + d)).alias(f"_{name}{d + 1}") for name, m in (("lo", low), ("hi", high)) for d in (-1, 0)])
    for key, name in (("DayOfWeek", "_dow"), ("Promo", "_promo"), ("Month", "_month")):
        stores = stores.join(sums(key, name), "Store", "left")
    fb, others = aggs.fallbacks, F.col("_all") - 1
    out = df.drop(*[c for c in LEAVE_ONE_OUT_COLUMNS if c in df.columns]).join(stores, "Store", "left")

    def kth(name: str):
        return F.when(x > F.col(f"_{name}0"), F.col(f"_{name}0")).otherwise(F.col(f"_{name}1"))

    def keyed(name: str, key: str):
        e = F.try_element_at(F.col(name), F.col(key))
        return F.try_divide(e["s"] - x, (e["n"] - 1).cast("double"))

    own_dev = x - F.col("_sum") / F.col("_all")
    cols = {"StoreMeanSales": F.try_divide(F.col("_sum") - x, others),
            "StoreMedianSales": F.when(others > 0, (kth("lo") + kth("hi")) / 2),
            # Leaving x out takes dev^2 * n / (n - 1) off the squared deviations.
            "StoreStdSales": F.when(others == 1, 0.0).when(others > 1, F.sqrt(F.greatest(
                F.try_divide(F.col("_dev") - F.try_divide(own_dev * own_dev * F.col("_all"), others), others - 1), F.lit(0.0)))),
            "StoreMaxSales": F.when(x < F.col("_top"), F.col("_top")).otherwise(F.col("_second")),
            "StoreOpenDays": F.when(others > 0, others)}
    if with_cust:
        left = F.col("_cust") - F.coalesce("Customers", F.lit(0))
        cols["StoreMeanCustomers"] = F.try_divide(left.cast("double"), (F.col("_custs") - F.col("Customers").isNotNull().cast("int")).cast("double"))
        cols["StoreSalesPerCustomer"] = F.when(others > 0, (F.col("_sum") - x) / F.greatest(left, F.lit(1)))
    cols |= {"StoreDowMeanSales": keyed("_dow", "DayOfWeek"), "StorePromoMeanSales": keyed("_promo", "Promo"),
             "StoreMonthMeanSales": keyed("_month", "Month")}
    keep = [c for c in df.columns if c not in LEAVE_ONE_OUT_COLUMNS]
    fitted = aggs.transform(df)
    out = out.filter(used).select(*keep, *[F.coalesce(c, F.lit(float(fb[name] or 0.0))).alias(name) for name, c in cols.items()])
    mean = F.nullif(F.col("StoreMeanSales"), F.lit(0.0))
    out = out.withColumns({"DowSalesIndex": F.coalesce(F.col("StoreDowMeanSales") / mean, F.lit(1.0)),
                           "MonthSalesIndex": F.coalesce(F.col("StoreMonthMeanSales") / mean, F.lit(1.0))})
    return out.unionByName(fitted.filter(~used).select(*out.columns))


def engineer_features(df: DataFrame, calendar: DataFrame | None = None,
                      store_aggregates: StoreAggregates | None = None,
                      epoch: str = DEFAULT_EPOCH) -> tuple[DataFrame, StoreAggregates | None]:  # C08
    """C04 -> C05 -> C06 -> C07 (fitted here if not given and Sales exists)."""
    out = competition_promo_features(holiday_features(date_features(df, epoch), calendar))
    if store_aggregates is None and "Sales" in out.columns:
        store_aggregates = fit_store_aggregates(out)
    if store_aggregates is not None:
        out = store_aggregates.transform(out)
    return out, store_aggregates
