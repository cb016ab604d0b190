"""Parquet tables laid out by date, and the option-driven database adapter."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kilnwatt.operators.joins import EPOCH_CURSOR, insert_ignore
from kilnwatt.schemas import PROCESSED_COLUMNS


def dated(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn("date", F.to_date(time))


def write_by_date(df: DataFrame, path: str, mode: str = "append", time: str = "time") -> int:
    """Write one folder per date and return the row count, which the write itself reports.

    The rebalance hint gathers each date into few files, yet lets Spark split a date that is too big for one
    task. Sorting by load type and time gives row groups narrow ranges to skip by.
    """
    order = [c for c in ("date", "load_type", time) if c == "date" or c in df.columns]
    written = Observation()
    (
        dated(df, time)
        .hint("rebalance", "date")
        .sortWithinPartitions(*order)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .partitionBy("date")
        .parquet(path)
    )
    return written.get["rows"]


def read_by_date(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The table with its `date` folder column; `in_time_range` prunes on it."""
    return spark.read.schema(f"{ddl}, date date").parquet(path)


def date_folders(table: DataFrame) -> list[str]:
    """The dates a table by date has files for, oldest first, from the file names Spark has already listed."""
    found = {m.group(1) for f in table.inputFiles() if (m := re.search(r"/date=(\d{4,}-\d\d-\d\d)/", f))}
    return sorted(found)


def _end_of(table: DataFrame, days: list[str], pick: Callable[[str], Column], time: str) -> DataFrame | None:
    """One row with the picked time of the first of the given dates that has any; each look reads one date."""
    for day in days:
        one = table.where(F.col("date") == F.lit(day).cast("date")).agg(pick(time).alias("at"))
        if one.first()[0] is not None:
            return one
    return None


def newest_time(spark: SparkSession, path: str, ddl: str, default: str = EPOCH_CURSOR, time: str = "time") -> DataFrame:
    """One row with the `cursor` to resume from, read from the newest date alone; the default for an empty table."""
    table = read_by_date(spark, path, ddl)
    end = _end_of(table, date_folders(table)[::-1], F.max, time)
    return spark.sql(f"SELECT timestamp'{default}' AS cursor") if end is None else end.withColumnRenamed("at", "cursor")


def time_ends(spark: SparkSession, path: str, ddl: str, time: str = "time") -> DataFrame:
    """One row with first_time and last_time of a table by date, read from its oldest and its newest date alone."""
    table = read_by_date(spark, path, ddl)
    days = date_folders(table)
    first, last = _end_of(table, days, F.min, time), _end_of(table, days[::-1], F.max, time)
    if first is None or last is None:
        return spark.createDataFrame([(None, None)], "first_time timestamp, last_time timestamp")
    return first.withColumnRenamed("at", "first_time").crossJoin(last.withColumnRenamed("at", "last_time"))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "time", mode: str = "append") -> None:
    """Append to a catalogue table whose files are bucketed and sorted by a key.

    Tables with the same buckets join on the key without an exchange. A bucket is one task, so keep plain tables where
    single keys have a large share of the rows: there the adaptive join splits them.
    """
    parts = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
    parts.format("parquet").option("path", path).saveAsTable(table)


def write_processed(df: DataFrame, path: str, mode: str = "append") -> int:
    return write_by_date(df.select(*PROCESSED_COLUMNS), path, mode)


def append_new(df: DataFrame, path: str, ddl: str, key: str = "time") -> int:
    """Append only rows whose key the table lacks; running it again adds nothing. Rows with a null key are left out.

    Of the target only the dates that occur among the incoming rows are read: at most one value for each day of the
    calendar, however many rows there are.
    """
    spark = df.sparkSession
    days = [r[0] for r in df.select(F.to_date(key)).where(F.col(key).isNotNull()).distinct().collect()]
    target = read_by_date(spark, path, ddl).where(F.col("date").isin(days))
    return write_by_date(insert_ignore(df, target, key), path, "append", key)


def create_table(spark: SparkSession, path: str, ddl: str, by: tuple[str, ...] = ("date",)) -> None:
    """An empty table, so that readers find its folder; an existing one is left alone."""
    spark.createDataFrame([], ddl).write.mode("ignore").partitionBy(*by).parquet(path)


def read_database(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    time_bounds: tuple[str, str] | None = None,
    partitions: int = 8,
) -> DataFrame:
    """Table over JDBC (driver jar and credentials are the caller's); with time bounds, read in parallel slices."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if time_bounds:
        low, high = time_bounds
        reader = reader.options(partitionColumn="time", lowerBound=low, upperBound=high, numPartitions=partitions)
    return reader.load()


def write_database(df: DataFrame, table: str, options: Mapping[str, str], page: int = 1000) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", page).mode("append").save()
