"""Feature plans: readings to processed readings, and the wider analysis set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatt.functions import calendar as cal
from kilnwatt.functions import measures as m
from kilnwatt.operators import series as sr
from kilnwatt.operators.filters import drop_incomplete, iqr_fences, outside_fences
from kilnwatt.operators.joins import with_scalar
from kilnwatt.operators.stats import own_moments, own_z
from kilnwatt.schemas import FEATURE_Z, PROCESSED_COLUMNS, ROWS_1H, ROWS_4H, ROWS_24H, ZParams

USAGE = "usage_kwh"


def add_calendar(df: DataFrame) -> DataFrame:
    df = df.withColumns(cal.calendar_parts(F.col("time")))
    hour = F.col("hour")
    return df.withColumns(
        {"shift": cal.shift_of(hour), "tariff_period": cal.tariff_of(hour), "day_period": cal.day_period_of(hour)}
    )


def add_power_factor(df: DataFrame) -> DataFrame:
    names = ("lagging_pf", "leading_pf", "lagging_reactive_power", "leading_reactive_power")
    return df.withColumns(m.power_factor(*map(F.col, names)))


def add_fixed_z(df: DataFrame, params: ZParams = FEATURE_Z) -> DataFrame:
    df = df.withColumn("z_score", m.fixed_z(F.col(USAGE), params))
    return df.withColumn("z_anomaly", m.spike_or_drop(F.col(USAGE), F.col("z_score"), params))


def with_row_features(rolled: DataFrame, params: ZParams = FEATURE_Z) -> DataFrame:
    """Everything derived from one row alone."""
    return rolled.transform(add_calendar).transform(add_power_factor).transform(add_fixed_z, params).transform(add_costs)


def add_costs(df: DataFrame) -> DataFrame:
    return df.withColumns(m.cost_columns(F.col(USAGE), F.col("tariff_period")))


def rolling_columns(frames: sr.Frames, day_frame: bool = False, change_of: str = USAGE) -> dict:
    columns = {
        "usage_ma_1h": sr.trailing_mean(USAGE, ROWS_1H, frames),
        "usage_ma_4h": sr.trailing_mean(USAGE, ROWS_4H, frames),
        "usage_diff": sr.change(USAGE, frames),
        "usage_pct_change": sr.percent_change(change_of, frames),
    }
    if day_frame:
        columns["usage_ma_24h"] = sr.trailing_mean(USAGE, ROWS_24H, frames)
    return columns


def add_rolling(
    df: DataFrame,
    tiebreak: Sequence[str] = (),
    fill: str | None = None,
    day_frame: bool = False,
    layout: sr.Layout = sr.DEFAULT_LAYOUT,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Rolling means and changes over the whole series; all frames share one exchange and one sort.

    `fill="pad"` carries the last known consumption over gaps before the percentage change is taken.
    """
    if fill not in (None, "pad"):
        raise ValueError(f"fill must be None or 'pad', not {fill!r}")
    change_of = USAGE
    if fill == "pad":
        change_of, narrow = "padded_usage", None
        df = sr.pad_forward(df, USAGE, change_of, tiebreak=tiebreak, layout=layout)
    reach = (ROWS_24H if day_frame else ROWS_4H) - 1
    values = list(dict.fromkeys([USAGE, change_of]))
    rolled = sr.over_series(
        df,
        lambda frames: rolling_columns(frames, day_frame, change_of),
        reach,
        values,
        tiebreak=tiebreak,
        layout=layout,
        narrow=narrow,
    )
    return rolled.drop("padded_usage")


def processed_readings(
    readings: DataFrame,
    params: ZParams = FEATURE_Z,
    tiebreak: Sequence[str] = (),
    fill: str | None = None,
    layout: sr.Layout = sr.DEFAULT_LAYOUT,
    keep_incomplete: bool = False,
) -> DataFrame:
    """The 30 columns of the processed table; rows before the first full hour frame are left out.

    The window step sees the raw columns only; everything derived per row is added after the exchange.
    """
    full = with_row_features(add_rolling(m.nan_to_null(readings), tiebreak, fill, layout=layout), params)
    kept = full if keep_incomplete else drop_incomplete(full)
    return kept.select(*PROCESSED_COLUMNS)


def analysis_features(
    readings: DataFrame, tiebreak: Sequence[str] = (), layout: sr.Layout = sr.DEFAULT_LAYOUT, **limits: int
) -> DataFrame:
    """The exploratory set: day of year, day-long mean, daily running sum, data-driven z and quartile flags."""
    clean = m.nan_to_null(readings)
    running = sr.running_sum_by_date(clean, tiebreak=tiebreak, layout=layout)
    wide = add_rolling(running, tiebreak, day_frame=True, layout=layout, narrow=clean)
    wide = wide.withColumn("day_of_year", F.dayofyear("time")).transform(add_calendar).transform(add_power_factor)
    # The table's own statistics come from the plain readings, so the windows aren't run for them.
    wide = with_scalar(wide, own_moments(clean).crossJoin(iqr_fences(clean, **limits).select("lower", "upper")))
    wide = wide.withColumn("z_score", own_z()).withColumn("iqr_outlier", outside_fences())
    return add_costs(wide.withColumn("z_anomaly", m.two_sided(F.col("z_score"))).drop("_mean", "_std", "lower", "upper"))
