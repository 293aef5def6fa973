"""Calendar column functions F01-F07 (pure column expressions, codegen-able)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: epoch of TimeIndex (a parameter; this is the default).
DEFAULT_EPOCH = "2013-01-01"


def day_of_week(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(d) + 1).cast("int")


def cyc(x: Column, period: float, fn) -> Column:
    return fn(F.lit(2 * math.pi) * x / F.lit(float(period)))


def date_feature_columns(d: Column, epoch: str = DEFAULT_EPOCH) -> dict[str, Column]:
    """The 26 calendar features of C04, in output order."""
    year, month, day = F.year(d), F.month(d), F.dayofmonth(d)
    dow = day_of_week(d)
    dim = F.dayofmonth(F.last_day(d))
    to_month_end = dim - day
    doy = F.dayofyear(d)
    to_xmas = F.datediff(F.make_date(year, F.lit(12), F.lit(25)), d)
    cols = {
        "Year": year,
        "Month": month,
        "Day": day,
        "WeekOfYear": F.weekofyear(d),
        "DayOfYear": doy,
        "Quarter": F.quarter(d),
        "DayOfWeek": dow,
        "IsWeekend": (dow >= 6).cast("int"),
        "IsSunday": (dow == 7).cast("int"),
        "DaysInMonth": dim,
        "IsMonthStart": (day <= 10).cast("int"),
        "IsMidMonth": ((day > 10) & (day <= 20)).cast("int"),
        "IsMonthEnd": (day > 20).cast("int"),
        "MonthPhase": F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2),
        "DaysToMonthEnd": to_month_end,
        "IsPayWeek": ((to_month_end <= 3) | (day <= 3)).cast("int"),
        "MonthSin": cyc(month, 12, F.sin),
        "MonthCos": cyc(month, 12, F.cos),
        "DayOfWeekSin": cyc(dow, 7, F.sin),
        "DayOfWeekCos": cyc(dow, 7, F.cos),
        "DayOfYearSin": cyc(doy, 365.25, F.sin),
        "DayOfYearCos": cyc(doy, 365.25, F.cos),
        "TimeIndex": F.datediff(d, F.to_date(F.lit(epoch))),
        "IsDecember": (month == 12).cast("int"),
        "DaysToChristmas": to_xmas,
        "IsChristmasRunUp": to_xmas.between(0, 21).cast("int"),
    }
    return {k: (v.cast("int") if k not in ("MonthSin", "MonthCos", "DayOfWeekSin", "DayOfWeekCos",
                                           "DayOfYearSin", "DayOfYearCos") else v)
            for k, v in cols.items()}


def week_start_sunday(d: Column) -> Column:
    """Preceding Sunday (the same day on a Sunday)."""
    return F.date_sub(d, F.dayofweek(d) - 1)
