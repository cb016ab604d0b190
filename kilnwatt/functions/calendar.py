"""Calendar, shift and tariff columns. Everything here is a plain Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilnwatt.schemas import DAY_NAMES


def calendar_parts(time: Column) -> dict[str, Column]:
    return {
        "hour": F.hour(time),
        "day": F.dayofmonth(time),
        "month": F.month(time),
        "quarter": F.quarter(time),
        "is_weekend": F.weekday(time) >= 5,  # Monday is 0
    }


def calendar_text(time: Column) -> dict[str, Column]:
    return {
        "nsm": (F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)).cast("int"),
        "day_of_week": F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.weekday(time) + 1),
        "week_status": F.when(F.weekday(time) >= 5, "Weekend").when(time.isNotNull(), "Weekday"),
    }


def shift_of(hour: Column) -> Column:
    return F.when(hour < 8, "night_shift").when(hour < 16, "day_shift").when(hour.isNotNull(), "evening_shift")


def tariff_of(hour: Column) -> Column:
    """Night tariff from 22:00 up to 06:00; works on whole and fractional hours."""
    return F.when((hour >= 22) | (hour < 6), "night").otherwise("day")


def day_period_of(hour: Column) -> Column:
    return (
        F.when(hour < 6, "midnight")
        .when(hour < 12, "morning")
        .when(hour < 18, "afternoon")
        .when(hour.isNotNull(), "evening")
    )


def clock_hour(time: Column, zone_mode: str = "utc") -> Column:
    """Fractional hour of the day, whole seconds only.

    `utc` counts from the epoch whatever the session zone is, as the compatible stream does;
    `session` reads the wall clock of the session zone instead.
    """
    if zone_mode == "utc":
        return (F.unix_timestamp(time) % 86400) / F.lit(3600)
    if zone_mode == "session":
        return (F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)) / F.lit(3600)
    raise ValueError(f"zone_mode must be 'utc' or 'session', not {zone_mode!r}")
