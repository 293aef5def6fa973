"""Explicit schemas of the retail inputs (never inferred; StateHoliday is a
string because raw files mix "0" and 0)."""

from pyspark.sql import types as T

DAILY = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Sales", T.LongType()),
    T.StructField("Customers", T.LongType()),
    T.StructField("Open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
])

FUTURE = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("Store", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
])

STORE = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("CompetitionOpenSinceMonth", T.IntegerType()),
    T.StructField("CompetitionOpenSinceYear", T.IntegerType()),
    T.StructField("Promo2", T.IntegerType()),
    T.StructField("Promo2SinceWeek", T.IntegerType()),
    T.StructField("Promo2SinceYear", T.IntegerType()),
    T.StructField("PromoInterval", T.StringType()),
])

STORE_STATES = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("State", T.StringType()),
])

STATE_NAMES = T.StructType([
    T.StructField("StateName", T.StringType()),
    T.StructField("State", T.StringType()),
])

# Weather columns kept from the 24 of the source (fixed list).
WEATHER_KEEP = [
    "Max_TemperatureC",
    "Mean_TemperatureC",
    "Min_TemperatureC",
    "Mean_Humidity",
    "Mean_Wind_SpeedKm_h",
    "Precipitationmm",
    "CloudCover",
]

TREND_RAW = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("week", T.StringType()),
    T.StructField("trend", T.IntegerType()),
])

REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("Store", T.IntegerType()),
    T.StructField("Date", T.StringType()),
    T.StructField("IsHoliday", T.IntegerType()),
    T.StructField("IsWeekend", T.IntegerType()),
    T.StructField("IsPromo", T.IntegerType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
    T.StructField("Open", T.IntegerType()),
])

# Request rows of a stream: ``n_rows`` announces how many rows the request has.
REQUEST_PART = T.StructType([*REQUEST.fields, T.StructField("n_rows", T.IntegerType())])

# Columns that must never be model inputs (target, secondary target, keys).
LEAKAGE_COLS = ["Customers", "Sales", "Date", "Id"]

CATEGORICAL_FEATURES = ["StoreType", "Assortment", "StateHoliday", "PromoInterval", "State"]
