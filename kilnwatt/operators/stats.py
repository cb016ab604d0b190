"""Aggregates: counts, shares, moments, quantile summaries, histograms and profiles.

Group keys here are load types, hours, weekdays, months, days or bins: their number is bounded by the calendar
or a parameter, and Spark combines each group inside the tasks before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kilnwatt.functions.measures import finite, percent, round_exact, two_sided
from kilnwatt.operators.filters import flag_iqr_outliers, iqr_fences
from kilnwatt.operators.joins import in_weekday_order, on_date_spine, with_scalar
from kilnwatt.operators.quantiles import exact_quantiles
from kilnwatt.schemas import NUMERIC_COLUMNS

USAGE = "usage_kwh"


def row_count(df: DataFrame, into: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(into))


def time_bounds(df: DataFrame, time: str = "time") -> DataFrame:
    return df.agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def ingest_report(df: DataFrame) -> DataFrame:
    """Total count and time bounds beside the count of every load type, largest first."""
    whole = df.agg(F.count(F.lit(1)).alias("total_rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))
    return with_scalar(count_by(df, "load_type"), whole).orderBy(F.desc("rows"), "load_type")


def count_by(df: DataFrame, key: str, into: str = "rows") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(into)).orderBy(F.desc(into), key)


def share_by(df: DataFrame, key: str = "load_type") -> DataFrame:
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = grouped.agg(F.sum("rows").alias("_total"))
    shared = with_scalar(grouped, total)
    return shared.select(key, "rows", round_exact(percent(F.col("rows"), F.col("_total")), 2).alias("share_pct")).orderBy(
        F.desc("rows"), key
    )


def moments(value: str = USAGE) -> list[Column]:
    return [
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def usage_stats(df: DataFrame, value: str = USAGE) -> DataFrame:
    return df.agg(*moments(value))


def mean_by(df: DataFrame, key: str, value: str = USAGE, into: str = "mean_usage") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(into)).orderBy(key)


def sum_by(df: DataFrame, key: str, value: str, into: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(into)).orderBy(key)


def moments_by(df: DataFrame, key: str = "week_status", value: str = USAGE, digits: int = 2) -> DataFrame:
    grouped = df.groupBy(key).agg(*moments(value))
    return grouped.select(key, *[round_exact(F.col(c), digits).alias(c) for c in ("mean", "std", "min", "max")]).orderBy(key)


def peak_and_trough(hourly: DataFrame, key: str = "hour", value: str = "mean_usage") -> DataFrame:
    """Key of the highest and of the lowest value; the smaller key wins a tie."""
    highest = F.max_by(key, F.struct(F.col(value), -F.col(key)))
    lowest = F.min_by(key, F.struct(F.col(value), F.col(key)))
    return hourly.where(F.col(value).isNotNull()).agg(
        highest.alias("peak_hour"),
        F.max(value).alias("peak_mean"),
        lowest.alias("trough_hour"),
        F.min(value).alias("trough_mean"),
    )


def weekday_mean(df: DataFrame, value: str = USAGE) -> DataFrame:
    return in_weekday_order(df.groupBy("day_of_week").agg(F.avg(value).alias("mean_usage")))


def describe(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, digits: int = 2, **limits: int) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of the finite values; one row per column."""
    columns = list(columns)
    clean = df.select(*[F.when(finite(F.col(c).cast("double")), F.col(c)).cast("double").alias(c) for c in columns])
    parts = clean.agg(
        *[f(c).alias(f"{c}__{n}") for c in columns for n, f in
          (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], **limits)
    lines = ", ".join(
        f"'{c}', {c}__count, {c}__mean, {c}__std, {c}__min, {c}[0], {c}[1], {c}[2], {c}__max" for c in columns
    )
    names = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    stacked = with_scalar(parts, quartiles).selectExpr(f"stack({len(columns)}, {lines}) as (column, count, {', '.join(names)})")
    return stacked.select("column", "count", *[round_exact(F.col(n), digits).alias(n) for n in names])


def own_moments(df: DataFrame, value: str = USAGE) -> DataFrame:
    return df.agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))


def own_z(value: str = USAGE) -> Column:
    """z-score against attached `own_moments`; null when the deviation is zero."""
    return F.try_divide(F.col(value) - F.col("_mean"), F.col("_std"))


def data_z(df: DataFrame, value: str = USAGE, into: str = "z_score") -> DataFrame:
    """z-score against the table's own mean and sample deviation."""
    return with_scalar(df, own_moments(df, value)).withColumn(into, own_z(value)).drop("_mean", "_std")


def savings(costed: DataFrame) -> DataFrame:
    """Total cost, what day-tariff use would save at the night tariff, and that share in percent."""
    saved = F.sum(F.when(F.col("tariff_period") == "day", F.col("cost_saving")))
    return costed.agg(F.sum("cost_tl").alias("total_cost"), saved.alias("total_saving")).withColumn(
        "saving_pct", percent(F.col("total_saving"), F.col("total_cost"))
    )


def daily_mean(df: DataFrame, value: str = USAGE, time: str = "time") -> DataFrame:
    return df.groupBy(F.to_date(time).alias("day")).agg(F.avg(value).alias("mean_usage"))


def daily_resample(df: DataFrame, value: str = USAGE, time: str = "time") -> DataFrame:
    return on_date_spine(daily_mean(df, value, time))


def hot_days(df: DataFrame, deviations: float = 2.0, limit: int | None = 10) -> DataFrame:
    """Days whose mean exceeds mean + n deviations of the daily means, highest first, with their total number."""
    days = daily_mean(df).where("mean_usage is not null")
    edge = days.agg((F.avg("mean_usage") + F.lit(deviations) * F.stddev_samp("mean_usage")).alias("_edge"))
    hot = with_scalar(days, edge).where(F.col("mean_usage") > F.col("_edge")).drop("_edge")
    numbered = with_scalar(hot, row_count(hot, "hot_days")).orderBy(F.desc("mean_usage"), "day")
    return numbered if limit is None else numbered.limit(limit)


def quartiles(df: DataFrame, value: str = USAGE, **limits: int) -> DataFrame:
    return iqr_fences(df, value, **limits).select("q1", "q3", "iqr")


def iqr_summary(df: DataFrame, value: str = USAGE, **limits: int) -> DataFrame:
    """Moments, fences, and how many rows lie outside them."""
    fenced = with_scalar(df.select(value), iqr_fences(df, value, **limits))
    outside = F.count_if((F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper")))
    return fenced.agg(
        *moments(value),
        F.max("lower").alias("lower"),
        F.max("upper").alias("upper"),
        outside.alias("outliers"),
        percent(outside, F.count(F.lit(1))).alias("outlier_pct"),
    )


def histogram(df: DataFrame, value: str = USAGE, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range of the finite values, the last one closed; empty bins count zero."""
    known = df.where(F.col(value).isNotNull() & finite(F.col(value))).select(F.col(value).alias("_v"))
    edges = known.agg(F.min("_v").alias("_min"), F.max("_v").alias("_max")).where(F.col("_min").isNotNull())
    # A single distinct value gets a range of one around it.
    flat = F.col("_min") == F.col("_max")
    edges = edges.select(
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_from"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("_max") - F.col("_min")) / F.lit(bins)).alias("_width"),
    )
    place = F.least(F.floor((F.col("_v") - F.col("_from")) / F.col("_width")), F.lit(bins - 1))
    filled = with_scalar(known, edges).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("_rows"))
    frame = edges.select("_from", "_width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(F.broadcast(filled), "bin", "left").select(
        "bin",
        (F.col("_from") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_from") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
        F.coalesce("_rows", F.lit(0)).alias("rows"),
    ).orderBy("bin")


def boxplot(df: DataFrame, value: str = USAGE, **limits: int) -> DataFrame:
    """Quartiles, whiskers at the last data inside the fences, and the number of points beyond."""
    box = exact_quantiles(df, [value], [0.25, 0.5, 0.75], **limits).select(
        *[F.col(value)[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    box = box.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    v = F.col(value)
    inside = v.between(F.col("_low"), F.col("_high"))
    return with_scalar(df.select(value), box).agg(
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"),
    )


def anomaly_summary(df: DataFrame, value: str = USAGE, limit: float = 3.0, **limits: int) -> DataFrame:
    """Rows, anomalies by the data-driven z rule with their rate, and outliers by the quartile rule."""
    both = flag_iqr_outliers(data_z(df.select(value), value), value, **limits)
    flagged = F.count_if(two_sided(F.col("z_score"), limit))
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        flagged.alias("z_anomalies"),
        percent(flagged, F.count(F.lit(1))).alias("z_rate_pct"),
        F.count_if("iqr_outlier").alias("iqr_outliers"),
    )


def rate(condition: Column) -> Column:
    """Percent of rows that meet a condition."""
    return F.avg(F.when(condition, 100.0).otherwise(0.0))


def feature_rates(features: DataFrame) -> DataFrame:
    return features.agg(
        rate(F.col("z_anomaly")).alias("anomaly_pct"),
        rate(F.col("low_pf_flag")).alias("low_pf_pct"),
        rate(F.col("tariff_period") == "night").alias("night_pct"),
        rate(F.col("tariff_period") == "day").alias("day_pct"),
    )


def flagged_rate(df: DataFrame, flag: str = "z_anomaly") -> DataFrame:
    """Percent of flagged rows, null for no rows."""
    return df.agg(percent(F.count_if(flag), F.count(F.lit(1))).alias("rate_pct"))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls (and NaN) of every column from one pass."""
    floating = {n for n, kind in df.dtypes if kind in ("double", "float")}
    missing = {c: F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull() for c in df.columns}
    counted = df.agg(*[F.count_if(m).alias(c) for c, m in missing.items()])
    lines = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counted.selectExpr(f"stack({len(df.columns)}, {lines}) as (column, nulls)")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def shape(df: DataFrame, original: int) -> DataFrame:
    """One row per column: its position and type, beside the row, column and derived-column counts."""
    columns = df.sparkSession.createDataFrame(
        [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, 1)], "position int, column string, dtype string"
    )
    wide = len(df.columns)
    return with_scalar(columns, row_count(df)).withColumns(
        {"n_columns": F.lit(wide), "derived_columns": F.lit(wide - original)}
    )


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Let the job that consumes `df` report metrics as it runs, at no extra pass."""
    observation = Observation(name)
    return df.observe(observation, *[m.alias(n) for n, m in metrics.items()]), observation
