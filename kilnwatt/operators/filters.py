"""Row filters: time range, load type, anomaly rules, routing to the result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwatt.operators.quantiles import exact_quantiles


def as_timestamp(bound) -> Column:
    return bound if isinstance(bound, Column) else F.lit(bound).cast("timestamp")


def in_time_range(df: DataFrame, start, end, time: str = "time") -> DataFrame:
    """Rows from `start` to `end`, both included. Where the table is laid out by date, whole days are pruned."""
    low, high = as_timestamp(start), as_timestamp(end)
    if "date" in df.columns:
        df = df.where(F.col("date").between(F.to_date(low), F.to_date(high)))
    return df.where(F.col(time).between(low, high))


def newer_than(df: DataFrame, as_of, interval: str, time: str = "time") -> DataFrame:
    """Rows later than `interval` (such as '1 hour') before `as_of`."""
    edge = as_timestamp(as_of) - F.expr(f"INTERVAL {interval}")
    if "date" in df.columns:
        df = df.where(F.col("date") >= F.to_date(edge))
    return df.where(F.col(time) > edge)


def with_load_types(df: DataFrame, chosen: Sequence[str] | None) -> DataFrame:
    """Rows of the chosen load types; None means no restriction, an empty choice no rows."""
    if chosen is None:
        return df
    return df.where(F.col("load_type").isin(list(chosen)) if chosen else F.lit(False))


def drop_incomplete(df: DataFrame, column: str = "usage_ma_1h") -> DataFrame:
    return df.na.drop(subset=[column])


def iqr_fences(df: DataFrame, value: str = "usage_kwh", reach: float = 1.5, **limits: int) -> DataFrame:
    """One row: q1, q3, iqr and the outlier fences of a column."""
    q = exact_quantiles(df, [value], [0.25, 0.75], **limits).select(F.col(value)[0].alias("q1"), F.col(value)[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - F.lit(reach) * iqr).alias("lower"),
        (F.col("q3") + F.lit(reach) * iqr).alias("upper"),
    )


def outside_fences(value: str = "usage_kwh") -> Column:
    """True outside attached `iqr_fences`."""
    return F.coalesce((F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper")), F.lit(False))


def flag_iqr_outliers(df: DataFrame, value: str = "usage_kwh", into: str = "iqr_outlier", **limits: int) -> DataFrame:
    fences = iqr_fences(df, value, **limits).select("lower", "upper")
    return df.crossJoin(F.broadcast(fences)).withColumn(into, outside_fences(value)).drop("lower", "upper")


def iqr_outliers(df: DataFrame, value: str = "usage_kwh", **limits: int) -> DataFrame:
    return flag_iqr_outliers(df, value, "_outlier", **limits).where("_outlier").drop("_outlier")


def route_anomalies(scored: DataFrame) -> DataFrame:
    """Rows flagged true, with a time, in the layout of the anomaly table (without its write stamp)."""
    return scored.where(F.col("z_anomaly").eqNullSafe(True) & F.col("time").isNotNull()).select(
        "time", "usage_kwh", "z_score", "load_type"
    )


def route_costs(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("time").isNotNull() & F.col("cost_tl").isNotNull()).select(
        "time", "usage_kwh", "tariff_type", "cost_tl", "load_type"
    )
