"""Competition and promotion column functions F09-F14."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations as they appear in PromoInterval
# (September is spelled "Sept").
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
              "Jul", "Aug", "Sept", "Oct", "Nov", "Dec"]
CITY_CENTRE_METRES = 500
NO_INTERVAL = ("None", "nan", "")


def month_abbr(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), month)


def promo2_start(year: Column, week: Column) -> Column:
    """Monday of week ``week`` (weeks start on the first Monday of the year,
    days before it are week 0); NULL when the year is not set (0/null)."""
    first_monday = F.next_day(F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1), "Mon")
    return F.when(year > 0, F.date_add(first_monday, (week - 1) * 7))


def competition_promo_columns(df_cols: dict[str, Column]) -> dict[str, Column]:
    """F09-F14 given Year, Month, Date and the store attribute columns."""
    c = df_cols
    has_date = c["CompetitionOpenSinceYear"] > 0
    months_open = 12 * (c["Year"] - c["CompetitionOpenSinceYear"]) + (c["Month"] - c["CompetitionOpenSinceMonth"])
    interval = F.coalesce(c["PromoInterval"], F.lit("None"))
    in_interval = (~interval.isin(*NO_INTERVAL)) & F.array_contains(F.split(interval, ","), month_abbr(c["Month"]))
    start = promo2_start(c["Promo2SinceYear"], c["Promo2SinceWeek"])
    started = F.coalesce(c["Date"] >= start, F.lit(False))
    active = ((c["Promo2"] == 1) & in_interval & started)
    weeks = F.when(c["Promo2"] == 1,
                   F.greatest(F.coalesce(F.datediff(c["Date"], start) / F.lit(7.0), F.lit(0.0)), F.lit(0.0))
                   ).otherwise(F.lit(0.0))
    return {
        "CompetitionOpenMonths": F.when(has_date, F.greatest(months_open, F.lit(0))).otherwise(0).cast("int"),
        "CompetitionIsNew": (has_date & months_open.between(0, 6)).cast("int"),
        "CompetitionNotYetOpen": (has_date & (months_open < 0)).cast("int"),
        "CompetitionDistanceLog": F.log1p(c["CompetitionDistance"]),
        "IsCityCentre": (c["CompetitionDistance"] <= CITY_CENTRE_METRES).cast("int"),
        "IsPromo2Active": active.cast("int"),
        "Promo2ActiveWeeks": weeks,
        "PromoAndPromo2": ((c["Promo"] == 1) & active).cast("int"),
        "AnyPromo": ((c["Promo"] == 1) | active).cast("int"),
    }
