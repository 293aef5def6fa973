"""Sources S01-S07: file readers with explicit schemas, the search-trend
parser, and a bundle that serves every input either from raw files or from
the derived fixture panel."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcast.session import materialize
from shopcast.sources import fixture, schemas

# Fixed values of the search-trend file format: file names are "<prefix>_DE"
# (national) or "<prefix>_DE_<state>", weeks "start - end".
TREND_FILE_PATTERN = "^[A-Za-z]+_DE_?"
TREND_WEEK_SEPARATOR = " - "


def classified_lines(spark: SparkSession, path: str, schema, date_format: str = "yyyy-MM-dd",
                     header: list[str] | None = None) -> DataFrame:
    """Every line of a CSV scan in one pass: ``_file``, ``_line``, ``_why``
    (the reason if it is no row, else NULL) and the typed cells. Rules as for
    ``scan_csv``."""
    header = header or spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # Cells by place: as many as the header has, and what a longer line has more.
    cells = F.from_csv(F.col("value"), ", ".join(f"`c{i}` string" for i in range(len(header) + 1)), {"mode": "PERMISSIVE"})
    # Commas inside quotes are no borders.
    outside = F.when(F.col("value").contains('"'), F.regexp_replace("value", r'"(?:[^"]|"")*"', "")).otherwise(F.col("value"))
    count = F.size(F.split(outside, ",", -1))
    first = F.transform(F.split(F.col("value"), ",", -1), lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))
    # Only a line that holds the first name can be a header: others skip the patterns.
    is_header = F.when(F.col("value").contains(header[0]), first == F.array(*[F.lit(c) for c in header])).otherwise(F.lit(False))
    lines = text.where(~is_header & (F.col("value") != "")).select("value", "file", count.alias("_cells"), cells.alias("_c"))

    def cell(f):
        return F.trim(F.col(f"_c.c{header.index(f.name)}"))

    def typed(f):
        kind = f.dataType.typeName()
        return F.try_to_date(cell(f), date_format) if kind == "date" else cell(f).try_cast(f.dataType)

    def reason(f):
        bad = cell(f).isNotNull() & (cell(f) != "") & typed(f).isNull()
        return F.when(bad, F.concat(F.lit(f"bad {f.dataType.simpleString()} in {f.name}: "), cell(f)))

    size = F.when(F.col("_cells") != len(header), F.concat(F.col("_cells").cast("string"), F.lit(f" cells for {len(header)} columns")))
    why = F.coalesce(size, *[reason(f) for f in schema.fields])
    return lines.select(F.col("file").alias("_file"), F.col("value").alias("_line"), why.alias("_why"),
                        *[typed(f).alias(f.name) for f in schema.fields])


def scan_csv(spark: SparkSession, path: str, schema, date_format: str = "yyyy-MM-dd",
             header: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """CSV scan with a declared schema (no inference pass over the data):
    (rows, rejects). Columns are found by their header names; a file without one
    of them raises ``ValueError``, further ones are ignored.

    A line whose number of cells differs from the header's, or with a cell that
    is no value of its column's type, is no row but a reject (file, line,
    reason), so one bad cell costs its own line only. Empty cells are NULL.
    Quoted cells may hold commas, not line ends; lines equal to the header are
    headers (each file may have one); ``header`` names the columns of files
    without one.
    """
    lines = classified_lines(spark, path, schema, date_format, header)
    rejects = lines.where("_why is not null").select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_why").alias("reason"))
    return lines.where("_why is null").select(*[f.name for f in schema.fields]), rejects


def read_csv(spark: SparkSession, path: str, schema, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The rows of ``scan_csv``, without its rejects."""
    return scan_csv(spark, path, schema, date_format)[0]


def load_daily(spark: SparkSession, path: str) -> DataFrame:      # S01
    return read_csv(spark, path, schemas.DAILY)


def load_future(spark: SparkSession, path: str) -> DataFrame:     # S02
    return read_csv(spark, path, schemas.FUTURE)


def load_store(spark: SparkSession, path: str) -> DataFrame:      # S03
    return read_csv(spark, path, schemas.STORE)


def state_lookup(store_states: DataFrame, state_names: DataFrame) -> DataFrame:  # S04
    """Store -> State code and long StateName (left join on State)."""
    return store_states.join(state_names, "State", "left").select("Store", "State", "StateName")


def weather_keep(weather: DataFrame) -> DataFrame:                # S05
    """Rename ``file`` to StateName and keep the weather columns present."""
    if "file" in weather.columns:
        weather = weather.withColumnRenamed("file", "StateName")
    keep = [c for c in schemas.WEATHER_KEEP if c in weather.columns]
    return weather.select("StateName", F.col("Date").cast("date").alias("Date"), *keep)


def parse_trend(raw: DataFrame, file_pattern: str = TREND_FILE_PATTERN) -> tuple[DataFrame, DataFrame]:   # S06
    """Split raw trend rows into (per_state, national).

    WeekStart is the first date of the ``week`` label; State is ``file``
    without the national prefix; an empty State is the national series,
    deduplicated per WeekStart (max, so the result does not depend on
    file order).
    """
    t = raw.select(
        F.to_date(F.split(F.col("week"), TREND_WEEK_SEPARATOR).getItem(0)).alias("WeekStart"),
        F.regexp_replace(F.col("file"), file_pattern, "").alias("State"),
        F.col("trend"),
    )
    national = (t.filter(F.col("State") == "").groupBy("WeekStart")
                .agg(F.max("trend").alias("TrendDE")))
    per_state = t.filter(F.col("State") != "").select(
        "State", "WeekStart", F.col("trend").alias("TrendState"))
    return per_state, national


@dataclass
class RetailInputs:
    """All raw inputs of one dataset as lazy DataFrames."""

    daily: DataFrame
    future: DataFrame
    store: DataFrame
    store_states: DataFrame
    state_names: DataFrame
    weather: DataFrame
    trend_raw: DataFrame
    epoch: str | None = None        # first day of the panel, where known
    rejects: DataFrame | None = None        # (table, file, line, reason) of lines that are no rows

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, materialized: bool = True) -> "DerivedInputs":
        """Inputs derived from the test tables, see ``DerivedInputs``."""
        return DerivedInputs(spark, sf_dir, materialized)

    @classmethod
    def from_csv(cls, spark: SparkSession, root: str) -> "RetailInputs":
        """Raw file layout: train.csv test.csv store.csv store_states.csv
        state_names.csv weather.csv googletrend.csv under ``root``."""
        def p(n):
            return f"{root.rstrip('/')}/{n}"

        header = spark.read.option("header", True).csv(p("weather.csv")).columns
        weather = T.StructType([T.StructField(c, T.DoubleType() if c in schemas.WEATHER_KEEP else T.DateType() if c == "Date" else T.StringType())
                                for c in header])
        files = {"daily": ("train.csv", schemas.DAILY), "future": ("test.csv", schemas.FUTURE), "store": ("store.csv", schemas.STORE),
                 "store_states": ("store_states.csv", schemas.STORE_STATES), "state_names": ("state_names.csv", schemas.STATE_NAMES),
                 "weather": ("weather.csv", weather), "trend_raw": ("googletrend.csv", schemas.TREND_RAW)}
        scans = {name: scan_csv(spark, p(file), schema) for name, (file, schema) in files.items()}
        rejects = [bad.select(F.lit(name).alias("table"), "*") for name, (_, bad) in scans.items()]
        return cls(**{name: rows for name, (rows, _) in scans.items()}, rejects=reduce(DataFrame.unionByName, rejects))


class DerivedInputs:
    """The inputs of ``RetailInputs`` derived from the test tables, each on its
    first use, so that a query pays for the inputs it reads.

    With ``materialized`` the trading days behind the daily panel and the
    (state, day) order aggregate behind weather and trends are written once to
    the checkpoint folder: the passes of a query read them instead of joining
    ``lineitem`` or ``orders`` again. The days between two trading days are
    made where the panel is read.
    """

    rejects = None

    def __init__(self, spark: SparkSession, sf_dir: str, materialized: bool = True):
        self.spark, self.sf_dir, self.materialized = spark, sf_dir, materialized

    def _once(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.materialized else df

    @cached_property
    def span(self) -> tuple[str, str]:
        return fixture.panel_span(self.spark, self.sf_dir)

    @property
    def epoch(self) -> str:
        return self.span[0]

    @cached_property
    def daily(self) -> DataFrame:
        spans = fixture.daily_spans(self.spark, self.sf_dir, self.span)
        return fixture.panel_rows(self._once(spans, "daily"), self.span)

    @cached_property
    def future(self) -> DataFrame:
        return fixture.future_rows(self.spark, self.sf_dir, self.span)

    @cached_property
    def store(self) -> DataFrame:
        return fixture.store_table(self.spark, self.sf_dir)

    @cached_property
    def _states(self) -> tuple[DataFrame, DataFrame]:
        return fixture.state_tables(self.spark, self.sf_dir)

    @property
    def store_states(self) -> DataFrame:
        return self._states[0]

    @property
    def state_names(self) -> DataFrame:
        return self._states[1]

    @cached_property
    def _by_day(self) -> DataFrame:
        return self._once(fixture.orders_by_state_day(self.spark, self.sf_dir), "orders_by_state_day")

    @cached_property
    def weather(self) -> DataFrame:
        return fixture.weather_table(self.spark, self.sf_dir, self._by_day)

    @cached_property
    def trend_raw(self) -> DataFrame:
        return fixture.trend_raw(self.spark, self.sf_dir, self._by_day)
