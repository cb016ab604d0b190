"""Power-factor, z-score, anomaly, cost and banding columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwatt.schemas import (
    DAY_TL_PER_KWH,
    LOW_POWER_FACTOR,
    NIGHT_TL_PER_KWH,
    PANEL_BASE_COLOUR,
    ZParams,
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN and infinities by null in every floating column.

    Spark ranks NaN above all numbers, and one infinite reading would take every mean and histogram with it.
    """
    floating = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(finite(F.col(c)), F.col(c)) for c in floating})


def finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def flag(condition: Column) -> Column:
    """Two-valued flag: an unknown comparison counts as false."""
    return F.coalesce(condition, F.lit(False))


def power_factor(lagging_pf: Column, leading_pf: Column, lagging_kvarh: Column, leading_kvarh: Column) -> dict[str, Column]:
    return {
        "pf_efficiency": (lagging_pf + leading_pf) / F.lit(2.0),
        "reactive_power_balance": lagging_kvarh - leading_kvarh,
        "low_pf_flag": flag(lagging_pf < LOW_POWER_FACTOR),
    }


def fixed_z(usage: Column, params: ZParams) -> Column:
    return (usage - F.lit(params.mean)) / F.lit(params.std)


def spike_or_drop(usage: Column, z: Column, params: ZParams) -> Column:
    """One-sided spike on z, or consumption under an absolute floor. NaN never flags."""
    real = ~F.isnan(usage)
    return flag(real & ((z > params.upper) | (usage < params.floor)))


def two_sided(z: Column, limit: float = 3.0) -> Column:
    return flag(~F.isnan(z) & (F.abs(z) > limit))


def tariff_rate(tariff: Column) -> Column:
    return F.when(tariff == "night", F.lit(NIGHT_TL_PER_KWH)).otherwise(F.lit(DAY_TL_PER_KWH))


def cost_columns(usage: Column, tariff: Column) -> dict[str, Column]:
    cost, at_night = tariff_rate(tariff) * usage, usage * F.lit(NIGHT_TL_PER_KWH)
    return {"cost_tl": cost, "cost_if_night": at_night, "cost_saving": cost - at_night}


def clamp(value: Column, low: float, high: float) -> Column:
    """Keep within bounds; null stays null although greatest/least would skip it."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def band(value: Column, steps: Sequence[tuple[str, float]], base: str = PANEL_BASE_COLOUR) -> Column:
    """Colour of the last step at or below the value."""
    colour = F.lit(base)
    for name, start in steps:
        colour = F.when(value >= F.lit(start), F.lit(name)).otherwise(colour)
    return F.when(value.isNotNull(), colour)


def round_exact(value: Column, digits: int) -> Column:
    """Decimal half-up rounding, as a numeric cast before ROUND gives; back to double."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, null when the whole is zero."""
    return F.try_divide(part * F.lit(100.0), whole)
