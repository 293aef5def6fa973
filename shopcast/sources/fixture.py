"""Derived retail panel built from the TPC-H-style test tables.

The raw retail files are not shipped, so every test, oracle and benchmark
runs on a store-by-day panel that Spark derives from ``supplier``,
``nation``, ``lineitem``, ``orders`` and ``customer`` (definitions in
FIXTURES.md section 2). All expressions are integer/string/date arithmetic
so Spark and the SQL oracle agree exactly.

Scale notes: the only large inputs are ``lineitem`` and ``orders``. Facts
are pre-aggregated to one row per (supplier, day), each with the days up to the
store's next one; the spine is ``explode(sequence(...))`` of these rows (no
cross join, no join of the spine with the facts). Broadcast are the 25-row
``nation`` table and the calendar days.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the derived panel (FIXTURES.md section 2).
FUTURE_DAYS = 48
PUBLIC_HOLIDAY_MONTH_DAYS = [(1, 1), (5, 1), (10, 3)]  # StateHoliday 'a'
EASTER_OFFSETS = [-2, 1]  # Good Friday and Easter Monday, StateHoliday 'b'
CHRISTMAS_DAYS = [25, 26]  # December, StateHoliday 'c'
FUTURE_HOLIDAY_DAY = 14  # day of the forecast rows with StateHoliday 'a'
PROMO_INTERVALS = {1: "Jan,Apr,Jul,Oct", 3: "Feb,May,Aug,Nov", 5: "Mar,Jun,Sept,Dec"}
NATIONAL_TREND_FILE = "Trend_DE"
STATE_TREND_PREFIX = "Trend_DE_"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _d(s: str):
    return F.to_date(F.lit(s))


def panel_span(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last ship date: the panel covers every row of ``lineitem``."""
    d = F.col("l_shipdate").cast("date")
    r = read_table(spark, sf_dir, "lineitem").agg(F.min(d).cast("string"), F.max(d).cast("string")).first()
    return (r[0], r[1]) if r[0] is not None else ("2000-01-01", "2000-01-01")


def easter_sunday(year):
    """Date of Easter Sunday of a year column (Gregorian computus)."""
    a, b, c = year % 19, F.floor(year / 100), year % 100
    h = (19 * a + b - F.floor(b / 4) - F.floor((b - F.floor((b + 8) / 25) + 1) / 3) + 15) % 30
    e = (32 + 2 * (b % 4) + 2 * F.floor(c / 4) - h - c % 4) % 7
    m = F.floor((a + 11 * h + 22 * e) / 451)
    n = h + e - 7 * m + 114
    return F.make_date(year.cast("int"), F.floor(n / 31).cast("int"), (n % 31 + 1).cast("int"))


def store_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per store: attributes derived from ``s_suppkey`` plus State."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    has_comp_date = (k % 3) != 0
    promo2 = (k % 2) == 1
    interval = F.lit(None).cast("string")
    for rem, label in sorted(PROMO_INTERVALS.items(), reverse=True):
        interval = F.when(k % 6 == rem, F.lit(label)).otherwise(interval)
    return (
        sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey)  # nation: 25 rows
        .select(
            k.cast("int").alias("Store"),
            F.when(k % 4 == 0, "a").when(k % 4 == 1, "b").when(k % 4 == 2, "c")
            .otherwise("d").alias("StoreType"),
            F.when(k % 3 == 0, "a").when(k % 3 == 1, "b").otherwise("c").alias("Assortment"),
            F.when(k % 10 != 3, (F.lit(70) + (k * 7919) % 20000).cast("double"))
            .alias("CompetitionDistance"),
            F.when(has_comp_date, 1 + k % 12).cast("int").alias("CompetitionOpenSinceMonth"),
            F.when(has_comp_date, 1995 + k % 7).cast("int").alias("CompetitionOpenSinceYear"),
            (k % 2).cast("int").alias("Promo2"),
            F.when(promo2, 1 + (k * 13) % 50).cast("int").alias("Promo2SinceWeek"),
            F.when(promo2, 1995 + k % 5).cast("int").alias("Promo2SinceYear"),
            interval.alias("PromoInterval"),
            F.col("n_name").alias("State"),
        )
    )


def store_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``store`` input (attributes only, no State)."""
    return store_dimension(spark, sf_dir).drop("State")


def state_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(store_states, state_names): State code per store, long names per code."""
    dim = store_dimension(spark, sf_dir)
    store_states = dim.select("Store", "State")
    nat = read_table(spark, sf_dir, "nation")
    state_names = nat.select(F.col("n_name").alias("StateName"), F.col("n_name").alias("State"))
    return store_states, state_names


def daily_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (store, day) with trading: Sales and distinct Customers.

    The ``orders`` side contributes only the customer key. The lines are dealt
    by store once: the distinct customers, the sums and what follows per store
    need no further exchange (a store's lines are some hundred).
    """
    li = (read_table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate")
          .filter(F.col("l_shipdate").isNotNull()))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    line_sales = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint")
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
        .select(F.col("l_suppkey").cast("int").alias("Store"), F.col("l_shipdate").cast("date").alias("Date"),
                line_sales.alias("_sales"), "o_custkey")
        .repartition("Store").groupBy("Store", "Date")
        .agg(F.sum("_sales").alias("Sales"),
             F.countDistinct("o_custkey").cast("bigint").alias("Customers"))
    )


def promo_flag(date_col, dow_col):
    return ((dow_col <= 5) & (F.weekofyear(date_col) % 2 == 0)).cast("int")


def state_holiday_code(date_col):
    is_a = F.lit(False)
    for m, d in PUBLIC_HOLIDAY_MONTH_DAYS:
        is_a = is_a | ((F.month(date_col) == m) & (F.dayofmonth(date_col) == d))
    is_b = F.datediff(date_col, easter_sunday(F.year(date_col))).isin(EASTER_OFFSETS)
    is_c = (F.month(date_col) == 12) & F.dayofmonth(date_col).isin(CHRISTMAS_DAYS)
    return F.when(is_a, "a").when(is_b, "b").when(is_c, "c").otherwise("0")


def daily_panel(spark: SparkSession, sf_dir: str, span: tuple[str, str] | None = None) -> DataFrame:
    """The ``daily`` input: store x day spine with the facts of each day."""
    span = span or panel_span(spark, sf_dir)
    return panel_rows(daily_spans(spark, sf_dir, span), span)


def daily_spans(spark: SparkSession, sf_dir: str, span: tuple[str, str]) -> DataFrame:
    """The panel with one row per store and trading day: the day's facts and
    the days (``_first`` to ``_last``) up to the store's next trading day; the
    first row of a store also holds the days before. A store without facts has
    one row. Days are numbered from the first of the panel. A store's window
    holds at most one row per calendar day."""
    start, end = (_d(x) for x in span)
    facts = daily_facts(spark, sf_dir).filter(F.col("Date").between(start, end)).select(
        "Store", F.datediff("Date", start).alias("_trading"), "Sales", "Customers")
    days = Window.partitionBy("Store").orderBy("_trading")
    facts = facts.withColumns({
        "_first": F.when(F.lag("_trading").over(days).isNotNull(), F.col("_trading")),
        "_last": F.lead("_trading").over(days) - 1})
    return store_dimension(spark, sf_dir).select("Store").join(facts, "Store", "left").select(
        "Store", "_trading", "Sales", "Customers", F.coalesce("_first", F.lit(0)).alias("_first"),
        F.coalesce("_last", F.datediff(end, start)).alias("_last"))


def panel_rows(spans: DataFrame, span: tuple[str, str]) -> DataFrame:
    """``daily_spans`` as one row per store and day. Nothing is shuffled or
    sorted here: the days of a span are made where the span is read. They meet
    the calendar by number: by date, Catalyst would also apply a condition on
    what the calendar derives from the date (the Easter computus) to each row."""
    trading = F.coalesce(F.col("_trading") == F.col("_day_no"), F.lit(False))
    return (
        spans.withColumn("_day_no", F.explode(F.sequence("_first", "_last")))
        .join(F.broadcast(panel_days(spans.sparkSession, *span)), "_day_no")  # one row per calendar day
        .select(
            F.col("Store"),
            F.col("DayOfWeek"),
            F.col("Date"),
            F.when(trading, F.coalesce(F.col("Sales"), F.lit(0))).otherwise(0).cast("bigint").alias("Sales"),
            F.when(trading, F.col("Customers")).otherwise(0).cast("bigint").alias("Customers"),
            F.when(trading | ((F.col("Store") + F.col("_day_no")) % 97 == 0), 1)
            .otherwise(0).cast("int").alias("Open"),
            "Promo", "StateHoliday", "SchoolHoliday",
        )
    )


def panel_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """What a panel row gets from its date alone, one row per calendar day:
    in every row of the panel the Easter computus is a method too long for the
    JIT compiler (tens of microseconds a row)."""
    days = spark.range(1).select(F.explode(F.sequence(_d(start), _d(end))).alias("Date"))
    dow = (F.weekday("Date") + 1)
    return days.select(
        "Date",
        dow.cast("int").alias("DayOfWeek"),
        promo_flag(F.col("Date"), dow).alias("Promo"),
        state_holiday_code(F.col("Date")).alias("StateHoliday"),
        F.month("Date").isin(7, 8).cast("int").alias("SchoolHoliday"),
        F.datediff(F.col("Date"), _d(start)).alias("_day_no"),
    )


def future_rows(spark: SparkSession, sf_dir: str, span: tuple[str, str] | None = None) -> DataFrame:
    """The ``future`` (test) input: the 48 days after the panel for every
    store, no Sales/Customers."""
    start, end = span or panel_span(spark, sf_dir)
    stores = store_dimension(spark, sf_dir).select("Store")
    first = F.date_add(_d(end), 1)
    rows = stores.select(
        "Store", F.explode(F.sequence(first, F.date_add(first, FUTURE_DAYS - 1))).alias("Date"))
    day_no = F.datediff(F.col("Date"), _d(start))
    dow = F.weekday("Date") + 1
    return rows.select(
        (F.col("Store").cast("bigint") * 1000 + day_no).cast("bigint").alias("Id"),
        F.col("Store"),
        dow.cast("int").alias("DayOfWeek"),
        F.col("Date"),
        F.when((F.col("Store") + day_no) % 97 == 5, F.lit(None))
        .when(dow == 7, F.lit(0.0)).otherwise(F.lit(1.0)).cast("double").alias("Open"),
        promo_flag(F.col("Date"), dow).alias("Promo"),
        F.when(F.col("Date") == F.date_add(first, FUTURE_HOLIDAY_DAY), "a").otherwise("0").alias("StateHoliday"),
        (F.month("Date") == 8).cast("int").alias("SchoolHoliday"),
    )


def orders_by_state_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders pre-aggregated to (state name, order day): order count and the
    sum of prices in cents. Weather and both trend series are re-aggregations
    of this table, so ``orders`` is joined and shuffled once, after partial
    aggregation; its size is bounded by states x days."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(F.broadcast(nat), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
            .groupBy(F.col("n_name"), F.col("o_orderdate").cast("date").alias("d"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")))


def weather_table(spark: SparkSession, sf_dir: str, by_day: DataFrame | None = None) -> DataFrame:
    """Sparse daily weather per state name (exercises the gap fills)."""
    x = by_day if by_day is not None else orders_by_state_day(spark, sf_dir)
    n = F.col("n")
    return x.select(
        F.col("n_name").alias("StateName"), F.col("d").alias("Date"),
        (F.col("cents").cast("double") / (n * F.lit(1000000.0))).alias("Mean_TemperatureC"),
        F.when(n > 1, n.cast("double")).alias("Precipitationmm"),
    )


def _sunday_week_start(d):
    return F.date_sub(d, F.dayofweek(d) - 1)


def _week_label(ws):
    return F.concat(F.date_format(ws, "yyyy-MM-dd"), F.lit(" - "),
                    F.date_format(F.date_add(ws, 6), "yyyy-MM-dd"))


def trend_raw(spark: SparkSession, sf_dir: str, by_day: DataFrame | None = None) -> DataFrame:
    """Raw weekly search-interest rows ``(file, week, trend)``: one series
    per state plus the national series, as the source file ships them."""
    x = (by_day if by_day is not None else orders_by_state_day(spark, sf_dir)).withColumn(
        "ws", _sunday_week_start(F.col("d")))
    per_state = x.groupBy("n_name", "ws").agg(F.sum("n").cast("int").alias("trend"))
    national = x.groupBy("ws").agg(F.sum("n").cast("int").alias("trend"))
    return (
        per_state.select(F.concat(F.lit(STATE_TREND_PREFIX), F.col("n_name")).alias("file"),
                         _week_label(F.col("ws")).alias("week"), "trend")
        .unionByName(national.select(F.lit(NATIONAL_TREND_FILE).alias("file"),
                                     _week_label(F.col("ws")).alias("week"), "trend"))
    )
