"""Data-quality checks. Each returns rows (check, value, passed); a table is read once per check set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.functions.measures import percent
from kilnwatt.operators.filters import newer_than
from kilnwatt.operators.joins import table_lag
from kilnwatt.schemas import LOAD_TYPES, MESSAGE_FIELDS, TARIFFS


def report(df: DataFrame, name: str, value: Column, passed: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), value.cast("double").alias("value"), passed.alias("passed"))


def tables_exist(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """For each name its (location, layout): is there a readable table that has all the columns?

    Only file listings and footers are read, so this looks at the catalogue, not the data.
    """
    rows = []
    for name, (location, ddl) in tables.items():
        wanted = {field.split()[0] for field in ddl.split(",")}
        try:
            have = set(spark.read.parquet(location).columns)
        except AnalysisException:  # no such table: that is the finding
            have = set()
        rows.append((f"exists:{name}", float(len(wanted & have)), wanted <= have))
    return spark.createDataFrame(rows, "check string, value double, passed boolean")


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        report(df.agg(F.count(F.lit(1)).alias("n")), f"non_empty:{name}", F.col("n"), F.col("n") > 0)
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def fresh_rows(df: DataFrame, as_of, interval: str = "1 hour") -> DataFrame:
    recent = newer_than(df, as_of, interval).agg(F.count(F.lit(1)).alias("n"))
    return report(recent, "fresh_rows", F.col("n"), F.col("n") > 0)


def usage_in_range(df: DataFrame, as_of, low: float = 0.0, high: float = 200.0, interval: str = "1 hour") -> DataFrame:
    """Smallest and largest recent consumption against their limits; no rows count as a pass with no value."""
    ends = newer_than(df, as_of, interval).agg(F.min("usage_kwh").alias("low"), F.max("usage_kwh").alias("high"))
    return ends.selectExpr(
        f"stack(2, 'usage_min', low, coalesce(low >= {low}D, true), 'usage_max', high, coalesce(high <= {high}D, true))"
        " as (check, value, passed)"
    )


def outside_enum(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct values that are not allowed; null is one of them."""
    legal = F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    return df.where(~legal).select(column).distinct()


def load_types_valid(df: DataFrame) -> DataFrame:
    wrong = outside_enum(df, "load_type", LOAD_TYPES).agg(F.count(F.lit(1)).alias("n"))
    return report(wrong, "load_type_enum", F.col("n"), F.col("n") == 0)


def tariffs_valid(costs: DataFrame) -> DataFrame:
    """Non-empty, and only the known tariffs."""
    seen = costs.groupBy("tariff_type").agg(F.lit(1).alias("one"))
    legal = F.coalesce(F.col("tariff_type").isin(list(TARIFFS)), F.lit(False))
    judged = seen.agg(F.count("one").alias("kinds"), F.count_if(~legal).alias("wrong"))
    return report(judged, "tariff_enum", F.col("wrong"), (F.col("kinds") > 0) & (F.col("wrong") == 0))


def time_not_null(df: DataFrame) -> DataFrame:
    missing = df.agg(F.count_if(F.col("time").isNull()).alias("n"))
    return report(missing, "time_not_null", F.col("n"), F.col("n") == 0)


def anomaly_rate_ok(features: DataFrame, as_of, high: float = 10.0, interval: str = "1 day") -> DataFrame:
    recent = newer_than(features, as_of, interval)
    rate = recent.agg(percent(F.count_if("z_anomaly"), F.count(F.lit(1))).alias("rate"))
    return report(rate, "anomaly_rate", F.col("rate"), F.coalesce(F.col("rate").between(0.0, high), F.lit(True)))


def anomaly_z_large(anomalies: DataFrame, limit: float = 3.0) -> DataFrame:
    """Anomalies within the z limit. Low-consumption drops are such rows by rule, so the count is reported as found."""
    small = anomalies.agg(F.count_if(F.abs("z_score") <= limit).alias("n"))
    return report(small, "anomaly_z", F.col("n"), F.col("n") == 0)


def processing_lag_ok(raw: DataFrame, processed: DataFrame, seconds: float = 300.0) -> DataFrame:
    lag = table_lag(raw, processed)
    return report(lag, "processing_lag", F.col("lag_seconds"), F.coalesce(F.col("lag_seconds") < seconds, F.lit(True)))


def message_fields(messages: DataFrame, fields: Sequence[str] = MESSAGE_FIELDS, marker: str = "tariff_period") -> DataFrame:
    """Of the messages in the current format (those with the marker field): how many carry every required field."""
    decoded = messages.select(F.from_json(F.col("value").cast("string"), "map<string,string>").alias("m"))
    has_all = F.lit(True)
    for field in fields:
        has_all = has_all & F.map_contains_key("m", field)
    current = decoded.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.map_contains_key("m", marker)).alias("current"),
        F.count_if(has_all).alias("complete"),
    )
    return report(current, "message_fields", F.col("complete"), (F.col("current") > 0) & (F.col("complete") == F.col("current")))
