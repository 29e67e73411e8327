"""Calendar features of a time column."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Hour ranges of the peaks (inclusive), weekend days with
# Sunday = 1, and the periods of the cyclic encodings.
PEAK_HOURS = {"IsMorningPeak": (7, 9), "IsEveningPeak": (16, 18)}
WEEKEND = (1, 7)
PERIODS = {"Hour": 24, "DayOfWeek": 7, "Month": 12}


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def is_month_end(ts: Column, mode: str = "last_day") -> Column:
    """``last_day``: the true last day of the month; ``late_days``: day 28 to 31."""
    if mode == "last_day":
        return flag(F.dayofmonth(ts) == F.dayofmonth(F.last_day(ts)))
    if mode == "late_days":
        return flag(F.dayofmonth(ts).between(28, 31))
    raise ValueError(f"unknown month-end mode {mode!r}")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position within a period."""
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def calendar_columns(ts: Column, month_end: str = "last_day") -> dict[str, Column]:
    """Every calendar feature of ``ts`` by name, for one ``withColumns``."""
    parts = {
        "Hour": F.hour(ts),
        "DayOfWeek": F.dayofweek(ts),
        "Month": F.month(ts),
        "WeekOfYear": F.weekofyear(ts),
        "DayOfMonth": F.dayofmonth(ts),
        "DayOfYear": F.dayofyear(ts),
    }
    columns = dict(parts)
    columns["IsMonthEnd"] = is_month_end(ts, month_end)
    columns["IsMonthStart"] = flag(parts["DayOfMonth"] == 1)
    for name, (first, last) in PEAK_HOURS.items():
        columns[name] = flag(parts["Hour"].between(first, last))
    columns["IsWeekend"] = flag(parts["DayOfWeek"].isin(*WEEKEND))
    for name, period in PERIODS.items():
        columns[f"{name}_sin"], columns[f"{name}_cos"] = cyclic(parts[name], period)
    return columns
