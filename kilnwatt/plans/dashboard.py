"""The seven queries of the anomaly dashboard, over the anomaly table.

`start` and `end` bound the reading time; `load_types` is the multi-select (None for all).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatt.functions.measures import round_exact
from kilnwatt.operators.filters import as_timestamp, in_time_range, with_load_types
from kilnwatt.operators.series import sort_series
from kilnwatt.operators.stats import count_by


def selected(anomalies: DataFrame, start, end, load_types: Sequence[str] | None = None) -> DataFrame:
    return with_load_types(in_time_range(anomalies, start, end), load_types)


def total_anomalies(anomalies: DataFrame, start, end, load_types=None) -> DataFrame:
    return selected(anomalies, start, end, load_types).agg(F.count(F.lit(1)).alias("total_anomalies"))


def mean_abs_z(anomalies: DataFrame, start, end, load_types=None) -> DataFrame:
    return selected(anomalies, start, end, load_types).agg(round_exact(F.avg(F.abs("z_score")), 2).alias("mean_abs_z"))


def max_usage(anomalies: DataFrame, start, end, load_types=None) -> DataFrame:
    return selected(anomalies, start, end, load_types).agg(round_exact(F.max("usage_kwh"), 2).alias("max_usage"))


def hours_since_last(anomalies: DataFrame, as_of) -> DataFrame:
    """Hours from the last detection to `as_of`, over the whole table."""
    passed = (F.unix_micros(as_timestamp(as_of)) - F.unix_micros(F.max("detected_at"))) / F.lit(3_600_000_000.0)
    return anomalies.agg(round_exact(passed, 1).alias("hours_since"))


def anomaly_series(anomalies: DataFrame, start, end, load_types=None) -> DataFrame:
    rows = selected(anomalies, start, end, load_types)
    return sort_series(rows.select("time", "usage_kwh", round_exact(F.col("z_score"), 2).alias("z_score")))


def anomalies_by_load(anomalies: DataFrame, start, end) -> DataFrame:
    return count_by(in_time_range(anomalies, start, end), "load_type", "anomalies")


# Column headings the dashboard's table shows.
DETAIL_HEADINGS = {"usage_kwh": "Tüketim (kWh)", "z_score": "Z-Score", "load_type": "Yük Tipi"}


def latest_anomalies(anomalies: DataFrame, start, end, load_types=None, limit: int = 50, headings: dict[str, str] | None = None) -> DataFrame:
    """Most recent anomalies, rounded; with `headings` the columns carry display names."""
    rows = selected(anomalies, start, end, load_types).orderBy(F.desc("time"), F.desc("usage_kwh")).limit(limit)
    named = {c: c for c in DETAIL_HEADINGS} | (headings or {})
    return rows.select(
        "time",
        round_exact(F.col("usage_kwh"), 2).alias(named["usage_kwh"]),
        round_exact(F.col("z_score"), 2).alias(named["z_score"]),
        F.col("load_type").alias(named["load_type"]),
    )
