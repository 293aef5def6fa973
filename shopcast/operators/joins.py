"""Joins J01-J05 and dataset assembly S07.

Scale: the fact (store x day) is the only large side. Store attributes and
the state lookup are first combined into ONE store dimension (dimension-to-
dimension join), so the fact meets it in a single join on Store; whether
that join broadcasts is left to Catalyst's size estimate and AQE's runtime
statistics, because the number of stores is not bounded by construction.
Weather and trend tables are keyed by (state, day/week): their size is
bounded by states x calendar days, independent of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.session import materialize
from shopcast.sources.readers import RetailInputs, parse_trend, state_lookup, weather_keep

# Fixed value: state code remap applied before the trend join (the trend
# source only publishes "NI" for the joint region "HB,NI").
TREND_STATE_MAP = {"HB,NI": "NI"}


def dimension_stats(dim: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows, largest multiplicity of a key) in one aggregate job."""
    r = dim.groupBy(*keys).count().agg(F.sum("count").alias("rows"), F.max("count").alias("dup")).first()
    return int(r.rows or 0), int(r.dup or 0)


def assert_unique(dim: DataFrame, keys: list[str], what: str = "dimension") -> int:
    """Raise ValueError if ``dim`` has more than one row per key (J01 guard);
    returns the row count. Checking the dimension is cheaper than
    recounting the fact after the join."""
    rows, dup = dimension_stats(dim, keys)
    if dup > 1:
        raise ValueError(f"{what} should have one row per {keys}; the join would change row count")
    return rows


def known_unique(dim: DataFrame, keys: list[str]) -> DataFrame:
    """A dimension whose keys ``assert_unique`` has checked, in a form that
    tells Catalyst so: a left join of which no column is read is then dropped
    from the plan. The rows stay as they are. (``dropDuplicates`` does the same,
    but Catalyst renames its columns late and an ``exceptAll`` of two frames
    over it does not find them.)"""
    rest = [F.first(c).alias(c) for c in dim.columns if c not in keys]
    return dim.groupBy(*keys).agg(*rest).select(*dim.columns) if rest else dim.distinct()


def join_dimension(fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join a dimension. No hint: Catalyst broadcasts a side whose size in
    bytes is below ``spark.sql.autoBroadcastJoinThreshold``, AQE decides again
    from the sizes that the shuffle measured."""
    return fact.join(dim, keys, how)


def merge_store(df: DataFrame, store: DataFrame, validate: bool = True) -> DataFrame:   # J01
    """Left-join store attributes on Store; the row count must not change."""
    if validate:
        assert_unique(store, ["Store"], "store")
    return join_dimension(df, store, ["Store"])


def week_start_sunday(date_col):
    """Preceding Sunday (the same day on a Sunday)."""
    return F.date_sub(date_col, F.dayofweek(date_col) - 1)


def trend_state_code(state_col):                                          # P02
    code = state_col
    for src, dst in TREND_STATE_MAP.items():
        code = F.when(state_col == src, F.lit(dst)).otherwise(code)
    return code


def attach_locality(df: DataFrame, weather: DataFrame, trend_raw: DataFrame,
                    validate: bool = True) -> DataFrame:                  # J03-J05
    """Weather on (StateName, Date), per-state trend on (state code, Sunday
    week start), national trend on week start. Each side is keyed by
    (state, day/week), so its size does not grow with the fact; its key is
    checked for uniqueness before the join."""
    per_state, national = parse_trend(trend_raw)
    per_state = per_state.withColumnRenamed("State", "TrendStateCode")
    w = weather_keep(weather)
    sides = [(w, ["StateName", "Date"], "weather"),
             (per_state, ["TrendStateCode", "WeekStart"], "trend per state"),
             (national, ["WeekStart"], "national trend")]
    if validate:
        for side, keys, what in sides:
            assert_unique(side, keys, what)
        sides = [(known_unique(side, keys), keys, what) for side, keys, what in sides]
    df = (df.withColumn("WeekStart", week_start_sunday(F.col("Date")))
          .withColumn("TrendStateCode", trend_state_code(F.col("State"))))
    for side, keys, _ in sides:
        df = join_dimension(df, side, keys)
    return df.drop("WeekStart", "StateName", "TrendStateCode")


def merge_external(df: DataFrame, store_states: DataFrame, state_names: DataFrame,
                   weather: DataFrame, trend_raw: DataFrame,
                   validate: bool = True) -> DataFrame:                   # J02-J05
    """Attach State, weather (StateName, Date) and weekly trends."""
    states = state_lookup(store_states, state_names)
    if validate:
        assert_unique(states, ["Store"], "store_states")
    return attach_locality(join_dimension(df, states, ["Store"]), weather, trend_raw, validate)


def store_dimension_full(inputs: RetailInputs, with_external: bool) -> DataFrame:
    """Store attributes (+ State/StateName) as one dimension keyed by Store."""
    dim = inputs.store
    if with_external:
        dim = dim.join(state_lookup(inputs.store_states, inputs.state_names), "Store", "left")
    return dim


def load_dataset(inputs: RetailInputs, kind: str = "train", with_external: bool = True,
                 validate: bool = True) -> DataFrame:                     # S07
    """Scan -> store join -> (state, weather, trend joins). No sort: every
    ordered operator downstream states its own Window order."""
    if kind not in {"train", "test"}:
        raise ValueError(f"kind must be 'train' or 'test', got {kind!r}")
    df = inputs.daily if kind == "train" else inputs.future
    # Written, so that its bytes are known: Catalyst estimates a join of
    # dimensions by the product of their sizes and would sort the fact.
    dim = materialize(store_dimension_full(inputs, with_external), "dimension")
    if validate:
        assert_unique(dim, ["Store"], "store")
        dim = known_unique(dim, ["Store"])
    df = join_dimension(df, dim, ["Store"])
    if with_external:
        df = attach_locality(df, inputs.weather, inputs.trend_raw, validate)
    return df
