"""The standard frames every analysis starts from, built once per dataset.

``raw``   R: daily rows joined with store, state, weather and trends
``test``  E: forecast rows joined the same way
``clean`` T: C03 (missing values, trading days, outlier flag) + C08 features
``calendar``: holiday dates of R and E (U01)

The daily panel and the orders by state and day are written to the shared
checkpoint folder (``materialize``), so a lost executor recomputes a Parquet
read and some joins. The frames themselves are not: written with all columns,
every query paid for columns that it never reads.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcast.functions.calendar import DEFAULT_EPOCH
from shopcast.operators.clean import clean_dataset
from shopcast.operators.features import engineer_features, holiday_calendar
from shopcast.operators.joins import assert_unique, load_dataset
from shopcast.session import materialize
from shopcast.sources.readers import DerivedInputs, RetailInputs

# Share of weekdays from which a store counts as always open, and its value
# for the derived panel (FIXTURES.md 2.5), whose stores trade on few days.
OPENER_THRESHOLD = 0.95
PANEL_OPENER_THRESHOLD = 0.22
SPLIT_DAYS = 42


class PanelContext:
    """The frames of one dataset, each planned on its first use. ``raw``,
    ``test`` and ``clean`` are plans over the written daily panel: a query
    computes the columns it reads and no others, and nothing for a frame it
    does not read. Fitted state (calendar, fences, store aggregates) is
    written."""

    def __init__(self, spark: SparkSession, inputs: RetailInputs | DerivedInputs, materialized: bool = True,
                 with_external: bool = True, opener_threshold: float = OPENER_THRESHOLD):
        self.spark, self.inputs = spark, inputs
        self.materialized, self.with_external = materialized, with_external
        self.opener_threshold = opener_threshold
        self.extra: dict = {}

    @property
    def epoch(self) -> str:
        return self.inputs.epoch or DEFAULT_EPOCH

    @cached_property
    def raw(self) -> DataFrame:
        return load_dataset(self.inputs, "train", with_external=self.with_external)

    @cached_property
    def test(self) -> DataFrame:
        return load_dataset(self.inputs, "test", with_external=self.with_external)

    @cached_property
    def calendar(self) -> DataFrame:
        calendar = holiday_calendar(self.raw, self.test)
        return materialize(calendar.coalesce(1), "calendar") if self.materialized else calendar

    @cached_property
    def clean(self) -> DataFrame:
        return engineer_features(clean_dataset(self.raw), calendar=self.calendar, epoch=self.epoch)[0]


_CACHE: dict = {}


def build_context(spark: SparkSession, sf_dir: str, materialized: bool = True,
                  with_external: bool = True) -> PanelContext:
    """R, E, calendar and T of the test tables under ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir, materialized, with_external)
    if key not in _CACHE:
        inputs = RetailInputs.from_fixture(spark, sf_dir, materialized)
        assert_unique(inputs.store, ["Store"], "store")     # for queries too that join no store
        _CACHE[key] = PanelContext(spark, inputs, materialized, with_external, PANEL_OPENER_THRESHOLD)
    return _CACHE[key]


def clear_cache() -> None:
    _CACHE.clear()


#: (from this magnitude on, decimals) of the comparison below, largest first.
COMPARED_DECIMALS = ((1e9, 2), (1e-3, 6), (0.0, 15))


def compared(c):
    """A double as the correctness gate compares it across engines: rounded
    far below its own size (2 decimals from 1e9 on, 15 below 1e-3, else 6), by
    plain IEEE arithmetic that any engine repeats bit by bit; unchanged from
    1e15 on. One short expression, and one for all where a row has many doubles:
    the JIT compiler leaves a method of over 8,000 bytes alone."""
    scale = F.lit(float(10 ** COMPARED_DECIMALS[-1][1]))
    for least, digits in reversed(COMPARED_DECIMALS[:-1]):
        scale = F.when(F.abs(c) >= least, float(10 ** digits)).otherwise(scale)
    return F.when(F.abs(c) < 1e15, F.floor(c * scale + 0.5).cast("double") / scale).otherwise(c)


#: Doubles of a row from which on they are rounded as one array.
MANY_DOUBLES = 8


def compared_doubles(df: DataFrame) -> DataFrame:
    """``compared`` on every double column; the catalogue applies it to its
    results, operators return full doubles."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    if len(doubles) < MANY_DOUBLES:
        return df.select(*[compared(F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns])
    rounded = df.withColumn("_compared", F.transform(F.array(*doubles), compared))
    return rounded.select(*[F.get("_compared", F.lit(doubles.index(c))).alias(c) if c in doubles else F.col(c) for c in df.columns])
