"""Anti-joins, one-row statistics, and small dimension joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnwatt.operators.filters import as_timestamp
from kilnwatt.schemas import DAY_NAMES

EPOCH_CURSOR = "2000-01-01 00:00:00"  # fixed value: where a first run starts


def since(df: DataFrame, edge: Column) -> DataFrame:
    """Where the table is laid out by date, only the dates from that of `edge` on; the rest is never listed as input."""
    return df.where(F.col("date") >= F.to_date(edge)) if "date" in df.columns else df


def resume_cursor(processed: DataFrame, default: str = EPOCH_CURSOR, time: str = "time") -> DataFrame:
    """One row: the last processed time, or the default for an empty table."""
    return processed.agg(F.coalesce(F.max(time), F.lit(default).cast("timestamp")).alias("cursor"))


def publish_cursor(as_of, back: str = "1 hour"):
    return as_timestamp(as_of) - F.expr(f"INTERVAL {back}")


def not_in(df: DataFrame, seen: DataFrame, key: str = "time") -> DataFrame:
    """Rows whose key is absent from `seen`; a null key is never present there.

    Both sides are exchanged for the join alone, so that the adaptive skew join can split a key with many rows.
    Reducing `seen` to distinct keys first would put an aggregate in between, and the rule would not apply.
    """
    return df.join(seen.select(key), key, "left_anti").select(*df.columns)


def unprocessed(raw: DataFrame, processed: DataFrame, cursor, limit: int | None = 500, time: str = "time") -> DataFrame:
    """Oldest raw rows after the cursor that the processed table lacks.

    The cursor also bounds the processed side: older rows there cannot match. On both sides dates before it are pruned. If
    both are bucketed alike by time (`write_bucketed`), neither is exchanged.
    """
    edge = as_timestamp(cursor)
    fresh = not_in(since(raw, edge).where(F.col(time) > edge), since(processed, edge).where(F.col(time) > edge), time).orderBy(time)
    return fresh if limit is None else fresh.limit(limit)


def next_page(df: DataFrame, cursor, limit: int = 100, time: str = "time", tiebreak: str | None = None, after=None) -> DataFrame:
    """Rows following the cursor in time order.

    A page continues inside a group of equal times, which a cursor on time alone would skip: `after` is the last row's
    value of the tie-breaker, a column or, without one, `row_mark`. Rows equal in every column count as one then.
    """
    edge = as_timestamp(cursor)
    order = row_mark(df) if tiebreak is None else F.col(tiebreak)
    later = F.col(time) > edge
    if after is not None:
        later = later | ((F.col(time) == edge) & (order > F.lit(after)))
    return since(df, edge).where(later).orderBy(F.col(time), order).limit(limit)


def row_mark(df: DataFrame) -> Column:
    """The tie-breaker of pages without a named one: a hash of the whole row."""
    return F.xxhash64(*df.columns)


def one_per_key(df: DataFrame, key: str = "time") -> DataFrame:
    """One row per key, the smallest in column order, so that reruns pick the same one.

    Before the exchange each task keeps one row per key, so a key with a third of the rows arrives as one row per task.
    """
    rest = [F.col(c) for c in df.columns if c != key] or [F.lit(1)]
    first = Window.partitionBy(key).orderBy(*rest)
    return df.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") == 1).drop("_nth")


def insert_ignore(incoming: DataFrame, target: DataFrame, key: str = "time") -> DataFrame:
    """Rows an insert that ignores conflicts on the key would add.

    The key may not be null in the target, so rows without one are left out. What is already there is dropped first.
    """
    return one_per_key(not_in(incoming.where(F.col(key).isNotNull()), target, key), key)


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row."""
    return df.crossJoin(F.broadcast(one_row))


def in_weekday_order(df: DataFrame, day: str = "day_of_week") -> DataFrame:
    """Monday to Sunday, a missing day with nulls."""
    spark = df.sparkSession
    days = spark.createDataFrame(list(enumerate(DAY_NAMES, 1)), f"day_order int, {day} string")
    return days.join(df, day, "left").orderBy("day_order")


def on_date_spine(daily: DataFrame, day: str = "day") -> DataFrame:
    """Every calendar day from the first to the last, absent ones with nulls."""
    spine = daily.agg(F.min(day).alias("first"), F.max(day).alias("last")).where(F.col("first").isNotNull())
    spine = spine.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias(day))
    return spine.join(daily, day, "left").orderBy(day)


def table_lag(raw: DataFrame, processed: DataFrame, time: str = "time") -> DataFrame:
    """One row: newest raw and processed times and how many seconds the latter is behind."""
    newest = raw.agg(F.max(time).alias("last_raw")).crossJoin(F.broadcast(processed.agg(F.max(time).alias("last_processed"))))
    lag = (F.unix_micros("last_raw") - F.unix_micros("last_processed")) / F.lit(1e6)
    return newest.withColumn("lag_seconds", lag)
