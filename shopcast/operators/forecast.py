"""Forecast-side operators: request validation S11, request template S12,
store broadcast J11, customers estimate C09, closed-day rule C10, seasonal
naive baseline, empirical intervals, and the batch forecast M16.

Everything runs as one job over all stores x horizon; there is no
per-store loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.operators.features import StoreAggregates

MAX_REQUEST_ROWS = 400
HORIZON_DAYS = 42
RULES = ["missing_date_column", "unparsable_date", "empty_request", "too_many_rows"]
UNKNOWN_STORE = "unknown_store"


def _parsed_date(req: DataFrame):
    return F.try_to_date(F.col("Date").cast("string")) if "Date" in req.columns else F.lit(None).cast("date")


def validate_requests(req: DataFrame, max_rows: int = MAX_REQUEST_ROWS, ids: DataFrame | None = None) -> DataFrame:    # S11
    """Constraint check per request: (request_id, rule, violations). ``ids``
    (request_id) lists the requests that were made, also those without rows;
    without it only requests with rows are known."""
    has_date = "Date" in req.columns
    g = req.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(F.when(_parsed_date(req).isNull(), F.lit(1))).alias("_bad"))
    if ids is not None:
        g = ids.select("request_id").distinct().join(g, "request_id", "left").fillna(0, ["_rows", "_bad"])
    counts = [F.lit(0 if has_date else 1), F.col("_bad") if has_date else F.lit(0),
              (F.col("_rows") == 0).cast("int"), (F.col("_rows") > max_rows).cast("int")]
    checks = F.array(*[F.struct(F.lit(r).alias("rule"), c.cast("bigint").alias("violations")) for r, c in zip(RULES, counts)])
    return g.select("request_id", F.inline(checks))


def screen_requests(req: DataFrame, store: DataFrame, max_rows: int = MAX_REQUEST_ROWS) -> DataFrame:
    """Every request row with ``reason``: NULL if it can be scored, else the
    rule it breaks. A request of too many rows is rejected as a whole."""
    sizes = req.groupBy("request_id").agg(F.count(F.lit(1)).alias("_rows"))
    known = store.select(F.col("Store"), F.lit(1).alias("_known")).distinct()
    out = req.join(sizes, "request_id", "left").join(known, "Store", "left")
    reason = (F.when(F.col("_rows") > max_rows, RULES[3])
              .when(_parsed_date(req).isNull(), RULES[1] if "Date" in req.columns else RULES[0])
              .when(F.col("_known").isNull(), UNKNOWN_STORE))
    return out.withColumn("reason", reason).select(*req.columns, "reason")


def normalize_requests(req: DataFrame) -> DataFrame:
    """Parse dates and default missing optional flags to 0 (Open to 1)."""
    out = req.withColumn("Date", F.try_to_date(F.col("Date").cast("string")))
    for c in ("IsHoliday", "IsWeekend", "IsPromo", "SchoolHoliday"):
        out = out.withColumn(c, F.coalesce(F.col(c).cast("int"), F.lit(0)) if c in out.columns else F.lit(0))
    out = out.withColumn("Open", F.coalesce(F.col("Open").cast("int"), F.lit(1)) if "Open" in out.columns
                         else F.lit(1))
    return out


def request_template(stores: DataFrame, start, days: int = HORIZON_DAYS) -> DataFrame:     # S12
    """``days`` daily request rows per store from ``start`` (a date column
    or literal): Date, IsHoliday=0, IsWeekend, IsPromo=0, SchoolHoliday=0."""
    rows = stores.select("Store", F.explode(F.sequence(start, F.date_add(start, days - 1))).alias("Date"))
    return rows.select("Store", "Date", F.lit(0).alias("IsHoliday"),
                       (F.weekday("Date") >= 5).cast("int").alias("IsWeekend"),
                       F.lit(0).alias("IsPromo"), F.lit(0).alias("SchoolHoliday"))


def requests_to_rows(req: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:     # J11
    """Raw-schema rows for scoring (with ``request_id``), and the rejected rows
    with their reason."""
    screened = screen_requests(req, store)
    r = normalize_requests(screened.filter(F.col("reason").isNull()))
    rows = r.select(
        "request_id", "Store", (F.weekday("Date") + 1).alias("DayOfWeek"), "Date", "Open",
        F.col("IsPromo").alias("Promo"),
        F.when(F.col("IsHoliday") == 1, "a").otherwise("0").alias("StateHoliday"), "SchoolHoliday")
    return rows.join(store, "Store", "inner"), screened.filter(F.col("reason").isNotNull())


def naive_forecast(rows: DataFrame, aggs: StoreAggregates, out: str = "PredictedSales") -> DataFrame:
    """Seasonal-naive baseline: the store's fitted mean for the weekday."""
    return aggs.transform(rows).withColumn(out, F.col("StoreDowMeanSales"))


def customers_estimate(df: DataFrame, pred: str = "PredictedSales",
                       ratio: str = "StoreSalesPerCustomer") -> DataFrame:                # C09
    """PredictedCustomers = pred / ratio, ties to even, when the ratio is positive."""
    return df.withColumn("PredictedCustomers",
                         F.when(F.col(ratio) > 0, F.bround(F.try_divide(F.col(pred), F.col(ratio)))).cast("bigint"))


def closed_rule(df: DataFrame, cols=("PredictedSales", "PredictedSalesLower", "PredictedSalesUpper",
                                       "PredictedCustomers")) -> DataFrame:                # C10
    """Closed days forecast zero (sales, bounds and customers)."""
    out = df
    for c in cols:
        if c in out.columns:
            out = out.withColumn(c, F.when(F.col("Open") == 0, F.lit(0).cast(out.schema[c].dataType))
                                 .otherwise(F.col(c)))
    return out


def empirical_interval(train: DataFrame, lower: float = 0.025, upper: float = 0.975) -> DataFrame:
    """Per (Store, DayOfWeek) empirical quantiles of Sales on training rows
    (bounded group: days of one weekday for one store)."""
    return train.groupBy("Store", "DayOfWeek").agg(
        F.percentile("Sales", F.array(F.lit(lower), F.lit(upper))).alias("_q")
    ).select("Store", "DayOfWeek", F.col("_q")[0].alias("lower"), F.col("_q")[1].alias("upper"))


def forecast_batch(requests: DataFrame, store: DataFrame, calendar: DataFrame, aggs: StoreAggregates,
                   model, epoch: str, with_interval: bool = True) -> tuple[DataFrame, DataFrame]:  # M16
    """Score every (store, day) request in one job.

    J11 (store attributes; rows that cannot be scored are returned with their
    reason) -> C01 in scoring mode -> calendar/holiday/promo features with the
    fitted calendar, plus the holidays that a request flags for its own rows
    (R20), so requests do not touch each other -> fitted store aggregates ->
    model (a forest also gives its tree-spread interval) -> customers (C09) ->
    closed-day rule (C10). Returns (forecast rows, rejected rows).
    """
    from shopcast.operators.clean import clean_missing
    from shopcast.operators.features import (competition_promo_features, date_features,
                                             holiday_features, request_holidays)
    rows, rejected = requests_to_rows(requests, store)
    feats = request_holidays(holiday_features(date_features(clean_missing(rows), epoch), calendar))
    feats = aggs.transform(competition_promo_features(feats))
    return score_features(feats, model, with_interval, ["request_id", "Store", "Date", "Open"]), rejected


def score_features(feats: DataFrame, model, with_interval: bool, keys: list[str]) -> DataFrame:
    """Predictions, customers and closed days of engineered rows."""
    from shopcast.operators import ml
    scored = ml.tree_interval(model, feats) if with_interval else ml.predict(model, feats)
    out = closed_rule(customers_estimate(scored))
    bounds = ["PredictedSalesLower", "PredictedSalesUpper"] if with_interval else []
    return out.select(*keys, "PredictedSales", *bounds, "PredictedCustomers")


def forecast_totals(forecast: DataFrame) -> DataFrame:
    """Totals of a batch forecast per request and store."""
    return forecast.groupBy("request_id", "Store").agg(F.sum("PredictedSales").alias("total_sales"),
                                                       F.sum("PredictedCustomers").cast("bigint").alias("total_customers"),
                                                       F.count(F.lit(1)).cast("bigint").alias("days"))
