"""The star-schema test data seen as telemetry: `events` becomes raw readings, and tables derive from those."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.functions.calendar import calendar_text
from kilnwatt.operators.filters import route_anomalies, route_costs
from kilnwatt.plans.features import add_calendar, add_costs, add_fixed_z, add_power_factor
from kilnwatt.schemas import RAW_COLUMNS
from kilnwatt.session import fresh_path
from kilnwatt.streaming.jobs import score

# The reading time on which runs resume, and the day the analysed slices start.
RESUME_AT = "2024-01-10 00:00:00"
SPLIT_AT = "2024-01-16 00:00:00"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events_as_readings(events)


def events_as_readings(events: DataFrame) -> DataFrame:
    event, time = F.col("event_id"), F.col("ts").cast("timestamp")
    load = (
        F.when(F.col("event_type") == "purchase", "Maximum_Load")
        .when(F.col("event_type").isin("error", "signup"), "Medium_Load")
        .otherwise("Light_Load")
    )
    return events.select(
        time.alias("time"),
        F.col("value").alias("usage_kwh"),
        (F.col("user_id") % 80).cast("double").alias("lagging_reactive_power"),
        (event % 20).cast("double").alias("leading_reactive_power"),
        ((event % 80).cast("double") / F.lit(1000.0)).alias("co2_tco2"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("lagging_pf"),
        ((event * 7) % 101).cast("double").alias("leading_pf"),
        load.alias("load_type"),
    ).withColumns(calendar_text(F.col("time"))).select(*RAW_COLUMNS)


def row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features that need one row only."""
    plain = readings(spark, sf_dir)
    return plain.transform(add_calendar).transform(add_power_factor).transform(add_fixed_z).transform(add_costs)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(row_features(spark, sf_dir))


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomaly table; detection is taken to be the reading time, so that results repeat."""
    return route_anomalies(scored(spark, sf_dir)).withColumn("detected_at", F.col("time"))


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_costs(scored(spark, sf_dir))


def processed_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run has processed: all light-load readings."""
    return readings(spark, sf_dir).where(F.col("load_type") == "Light_Load")


def newest(df: DataFrame, time: str = "time"):
    """Newest time of a table, the fixed point in place of a moving now."""
    return df.agg(F.max(time)).first()[0]


def metered(df: DataFrame) -> DataFrame:
    """Readings with a series column: eighty meters."""
    return df.withColumn("meter", F.col("lagging_reactive_power").cast("bigint"))


# Header of the source CSV, in the order of the raw columns.
CSV_HEADER = (
    "date", "Usage_kWh", "Lagging_Current_Reactive.Power_kVarh", "Leading_Current_Reactive_Power_kVarh", "CO2(tCO2)",
    "Lagging_Current_Power_Factor", "Leading_Current_Power_Factor", "NSM", "WeekStatus", "Day_of_week", "Load_Type",
)


def source_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as the source CSV spells them."""
    plain = readings(spark, sf_dir)
    return plain.withColumn("time", F.date_format("time", "dd/MM/yyyy HH:mm")).toDF(*CSV_HEADER)


def source_csv(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "csv")
    source_frame(spark, sf_dir).write.option("header", True).csv(path)
    return path


def arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The readings in two deliveries.

    First those before the split day except the maximum-load ones; then the rest, in which the held-back
    readings are late.
    """
    plain = readings(spark, sf_dir)
    early = F.col("time") < F.lit(SPLIT_AT).cast("timestamp")
    held_back = F.col("load_type") == "Maximum_Load"
    return plain.where(early & ~held_back), plain.where(~early | held_back)
