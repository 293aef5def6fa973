"""Label maps of the analysis tables (F23) and the fixed order of ordinal
labels (T02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The labels that reports show for coded values.
PROMO = {0: "No promo", 1: "Promo"}
WEEKDAY = {1: "Mon", 2: "Tue", 3: "Wed", 4: "Thu", 5: "Fri", 6: "Sat", 7: "Sun"}
ASSORTMENT = {"a": "a (basic)", "b": "b (extra)", "c": "c (extended)"}
PROMO2_ROUND = {0: "Promo2 dormant", 1: "Promo2 round active"}
PROMO2_MEMBER = {0: "Not in Promo2", 1: "In Promo2"}

#: Label map of a column of the evidence tables.
COLUMN_LABELS = {"Promo": PROMO, "DayOfWeek": WEEKDAY, "Assortment": ASSORTMENT, "IsPromo2Active": PROMO2_ROUND,
                 "Promo2": PROMO2_MEMBER}


def labelled(c: Column, labels: dict) -> Column:
    """The label of a coded value; a value without a label as text."""
    out = c.cast("string")
    for value, label in labels.items():
        out = F.when(c == F.lit(value), F.lit(label)).otherwise(out)
    return out


def label_columns(df: DataFrame) -> DataFrame:
    """Add ``<column>Label`` beside every column that has a label map."""
    return df.withColumns({f"{c}Label": labelled(F.col(c), m) for c, m in COLUMN_LABELS.items() if c in df.columns})


def in_order(df: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """Rows in the fixed order of an ordinal label column."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(column))
    return df.orderBy(place, column)
