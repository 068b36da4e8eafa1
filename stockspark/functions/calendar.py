"""Calendar expressions over a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weeks that carry the holiday flag.
HOLIDAY_WEEKS = (6, 36, 47, 52)

WEEKS_PER_YEAR = 52


def friday_on_or_after(moment: Column) -> Column:
    """The Friday that closes the week of ``moment`` (a Friday maps to itself)."""
    day = F.to_date(moment)
    return F.date_add(day, F.pmod(F.lit(11) - F.weekday(day), F.lit(7)))


def is_holiday_week(day: Column) -> Column:
    return F.weekofyear(day).isin(*HOLIDAY_WEEKS)


def calendar_parts(day: Column, weekend: bool = True) -> dict[str, Column]:
    """Year, Month, ISO WeekOfYear, DayOfYear, DayOfWeek (Monday = 0) and IsWeekend."""
    parts = {
        "Year": F.year(day),
        "Month": F.month(day),
        "WeekOfYear": F.weekofyear(day),
        "DayOfYear": F.dayofyear(day),
        "DayOfWeek": F.weekday(day),
    }
    if weekend:
        parts["IsWeekend"] = F.weekday(day).isin(5, 6).cast("int")
    return parts


def cyclic_parts(day: Column) -> dict[str, Column]:
    """Sine and cosine of the month (period 12) and of the ISO week (period 52)."""
    def angle(part: Column, period: int) -> Column:
        return part * F.lit(2.0) * F.pi() / F.lit(float(period))

    month, week = angle(F.month(day), 12), angle(F.weekofyear(day), WEEKS_PER_YEAR)
    return {
        "Month_sin": F.sin(month),
        "Month_cos": F.cos(month),
        "WeekOfYear_sin": F.sin(week),
        "WeekOfYear_cos": F.cos(week),
    }


def long_date(day: Column) -> Column:
    return F.date_format(day, "MMMM dd, yyyy")
