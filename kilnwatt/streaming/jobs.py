"""Continuous jobs. Each reuses the batch column functions and writes through `foreachBatch`.

Every micro-batch writes its own folders of a store and commits them together; a batch run again changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from kilnwatt.functions import calendar as cal
from kilnwatt.functions import measures as m
from kilnwatt.operators.filters import drop_incomplete, route_anomalies, route_costs
from kilnwatt.operators.series import DEFAULT_LAYOUT, Layout, series_order
from kilnwatt.plans.features import processed_readings, with_row_features
from kilnwatt.schemas import ANOMALY_DDL, COST_DDL, PROCESSED_DDL, RAW_COLUMNS, RAW_DDL, RAW_MESSAGE_DDL, ROWS_4H, STREAM_Z, ZParams, column_names
from kilnwatt.session import settings
from kilnwatt.sources.tables import append_new, create_table
from kilnwatt.sources.topic import decode_all, encode
from kilnwatt.streaming.commits import Store, remove
from kilnwatt.streaming.keyed import STORE_SETTINGS, keyed_frames
from kilnwatt.streaming.progress import MetricsLog, read_log

ONCE = {"availableNow": True}
FEATURES_EVERY = {"processingTime": "20 seconds"}
PUBLISH_EVERY = {"processingTime": "15 seconds"}

Batch = Callable[[DataFrame, int], None]


def score(decoded: DataFrame, params: ZParams = STREAM_Z, zone_mode: str = "utc") -> DataFrame:
    """Replace z_score, hour and cost by the stream's own; the anomaly flag of the feature stage is kept."""
    return (
        decoded.withColumn("z_score", m.fixed_z(F.col("usage_kwh"), params))
        .withColumn("hour", cal.clock_hour(F.col("time"), zone_mode))
        .withColumn("tariff_type", cal.tariff_of(F.col("hour")))
        .withColumn("cost_tl", m.tariff_rate(F.col("tariff_type")) * F.col("usage_kwh"))
    )


BLOCK = 10_000  # batches whose metrics are summed in one task


def replace_metrics(one_row: DataFrame, path: str, batch_id: int) -> None:
    one_row.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def with_totals(metrics: DataFrame, running: str) -> DataFrame:
    """Per-batch metrics with the running total of one of them.

    Batches are summed up in blocks, so that no task sees them all: the one window without partitions is over a row per
    `BLOCK` batches.
    """
    metrics = metrics.withColumn("_block", F.floor(F.col("batch_id") / BLOCK))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = metrics.groupBy("_block").agg(F.sum(running).alias("_sum"))
    blocks = blocks.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry"))
    so_far = Window.partitionBy("_block").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = metrics.withColumn("_inside", F.sum(running).over(so_far)).join(F.broadcast(blocks), "_block")
    return summed.withColumn("total", F.col("_carry") + F.col("_inside")).drop("_block", "_carry", "_inside")


SCORE_METRICS = "rows bigint, anomalies bigint, cost_rows bigint"
FEATURE_METRICS = "rows bigint, late bigint, anomalies bigint"
UNIQUE_METRICS = "rows bigint, late bigint, state_rows bigint"


def read_metrics(spark: SparkSession, folder: str, ddl: str, running: str = "rows") -> DataFrame:
    """What the progress of a job under `folder` has told about each batch, with a running total."""
    return with_totals(read_log(spark, f"{folder}/metrics", ddl), running)


def scores(folder: str) -> Store:
    return Store(folder, {"anomalies": ANOMALY_DDL, "cost_analysis": COST_DDL})


def fan_out(store: Store) -> Batch:
    """One scored micro-batch to the anomaly and the cost table, which show it together once both are written.

    A batch that is run again after its commit changes nothing.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        needed = batch.select("time", "usage_kwh", "z_score", "z_anomaly", "load_type", "tariff_type", "cost_tl")
        kept = needed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kept.isEmpty() or store.committed(batch.sparkSession, batch_id):
                return
            # The current time is one literal per write, so a batch has one detection time.
            store.write("anomalies", route_anomalies(kept).withColumn("detected_at", F.current_timestamp()), batch_id)
            store.write("cost_analysis", route_costs(kept), batch_id)
            store.commit(batch.sparkSession, batch_id)
        finally:
            kept.unpersist()

    return process


def run_batches(
    stream: DataFrame, process: Batch, checkpoint: str, trigger: Mapping[str, object], name: str | None = None
) -> StreamingQuery:
    writer = stream.writeStream.outputMode("append").foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).trigger(**trigger).start()


def run_watched(
    stream: DataFrame, process: Batch, folder: str, trigger: Mapping[str, object], ddl: str, **observed: Column
) -> StreamingQuery:
    """Run with per-batch metrics of the columns in `ddl` under `folder`: what the stream observes on the way to
    `process`, and what its watermark drops. `finish` waits for the last of them."""
    spark = stream.sparkSession
    name = f"watched-{uuid.uuid4().hex}"
    log = MetricsLog(spark, f"{folder}/metrics", name, ddl)
    seen = stream.observe(name, *[value.alias(column) for column, value in observed.items()])
    spark.streams.addListener(log)
    try:
        query = run_batches(seen, process, f"{folder}/checkpoint", trigger, name)
    except BaseException:
        spark.streams.removeListener(log)
        raise
    log.watch(query)
    return query


def start_scoring(decoded: DataFrame, folder: str, trigger: Mapping[str, object] = ONCE, zone_mode: str = "utc") -> StreamingQuery:
    """Decoded messages to anomalies, costs and metrics under one folder."""
    store = scores(folder)
    store.create(decoded.sparkSession)
    timed = F.col("time").isNotNull()
    return run_watched(
        score(decoded, zone_mode=zone_mode),
        fan_out(store),
        folder,
        trigger,
        SCORE_METRICS,
        rows=F.count(F.lit(1)),
        anomalies=F.count_if(F.col("z_anomaly").eqNullSafe(True) & timed),
        cost_rows=F.count_if(timed & F.col("cost_tl").isNotNull()),
    )


def read_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return scores(folder).read(spark, "anomalies")


def read_costs(spark: SparkSession, folder: str) -> DataFrame:
    return scores(folder).read(spark, "cost_analysis")


INGEST_METRICS = "rows bigint, dead bigint"
DEAD_DDL = "value string, reason string"


def ingest_store(folder: str, ddl: str = RAW_DDL) -> Store:
    return Store(folder, {"readings": ddl, "dead_letters": DEAD_DDL})


def start_ingest(messages: DataFrame, folder: str, ddl: str = RAW_MESSAGE_DDL, required: tuple[str, ...] = ("usage_kwh",), trigger: Mapping[str, object] = ONCE) -> StreamingQuery:
    """Messages to the raw table; those that can't be used are kept as they came, with the reason, in the same commit."""
    store = ingest_store(folder)
    store.create(messages.sparkSession)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)  # one parse for both tables
        try:
            if kept.isEmpty() or store.committed(spark, batch_id):
                return
            store.write("readings", kept.where("reason IS NULL").select(*RAW_COLUMNS), batch_id)
            store.write("dead_letters", kept.where("reason IS NOT NULL").select("value", "reason"), batch_id)
            store.commit(spark, batch_id)
        finally:
            kept.unpersist()

    sorted_out = decode_all(messages, ddl, required)
    dead = F.count_if(F.col("reason").isNotNull())
    return run_watched(sorted_out, process, folder, trigger, INGEST_METRICS, rows=F.count(F.lit(1)), dead=dead)


def features_store(folder: str) -> Store:
    return Store(folder, {"processed_readings": PROCESSED_DDL, "counts": FEATURE_METRICS})


def extend_features(folder: str, reach: int = ROWS_4H - 1, layout: Layout = DEFAULT_LAYOUT) -> Batch:
    """Features of new readings, continuing the rolling frames of the batches before.

    Between batches only the last `reach` readings are kept, in a folder per batch. A micro-batch of any size
    runs through the distributed series windows; no single task holds the series. Readings not later than the
    newest one already seen are late: they are counted and left out.
    """

    store = features_store(folder)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if store.committed(spark, batch_id):
            return
        tail = spark.read.schema(RAW_DDL).parquet(f"{folder}/tail/batch_id={batch_id - 1}")
        cursor = tail.agg(F.max(F.unix_micros("time"))).first()[0]  # a number, free of any time zone
        arrived = batch.select(*RAW_COLUMNS).where(F.col("time").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            on_time = F.lit(True) if cursor is None else F.unix_micros("time") > F.lit(cursor)
            series = tail.unionByName(arrived.where(on_time))
            features = processed_readings(series, layout=layout, keep_incomplete=True).where(on_time)
            store.write("processed_readings", drop_incomplete(features), batch_id)

            newest = [key.desc() for key in series_order(series, "time")]
            series.orderBy(*newest).limit(reach).write.mode("overwrite").parquet(f"{folder}/tail/batch_id={batch_id}")
            done = store.read(spark, "processed_readings", [(batch_id, batch_id)])
            counted = done.agg(F.count(F.lit(1)).alias("rows"), F.count_if("z_anomaly").alias("anomalies"))
            late = arrived.agg(F.count_if(~on_time).alias("late"))
            store.write("counts", counted.crossJoin(late).select("rows", "late", "anomalies"), batch_id)
            store.commit(spark, batch_id)
            remove(spark, f"{folder}/tail/batch_id={batch_id - 2}")  # a replay of this batch reads the tail before it
        finally:
            arrived.unpersist()

    return process


def start_features(
    readings: DataFrame, folder: str, trigger: Mapping[str, object] = FEATURES_EVERY, layout: Layout = DEFAULT_LAYOUT
) -> StreamingQuery:
    """Stream of raw readings to the processed table; batches are expected in time order."""
    spark = readings.sparkSession
    features_store(folder).create(spark)
    start = f"{folder}/tail/batch_id=-1"
    if not features_store(folder).runs(spark):
        spark.createDataFrame([], RAW_DDL).write.mode("ignore").parquet(start)
    return run_batches(readings, extend_features(folder, layout=layout), f"{folder}/checkpoint", trigger)


def read_processed(spark: SparkSession, folder: str) -> DataFrame:
    return features_store(folder).read(spark, "processed_readings")


def read_feature_counts(spark: SparkSession, folder: str) -> DataFrame:
    return with_totals(features_store(folder).read(spark, "counts"), "rows")


def start_unique(readings: DataFrame, folder: str, ddl: str = RAW_DDL, trigger: Mapping[str, object] = ONCE) -> StreamingQuery:
    """Stream into a table keyed by time: readings stored at any time before add nothing.

    Copies inside a batch collapse before the exchange, and copies of stored rows drop out in an anti-join on
    the dates at hand, so neither state nor a watermark is needed and no hot key fills a task.
    """
    path = f"{folder}/readings"
    create_table(readings.sparkSession, path, f"{ddl}, date date")

    def process(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            append_new(batch, path, ddl)

    return run_batches(readings, process, f"{folder}/checkpoint", trigger)


def unique_store(folder: str, ddl: str = RAW_DDL) -> Store:
    return Store(folder, {"readings": ddl})


def stored(store: Store, table: str, only: str = "true") -> Batch:
    """Write the rows of each batch that fulfil a condition to one table of a store.

    The batch is evaluated once, as its state may only move on once.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not store.committed(spark, batch_id):
            columns = column_names(store.tables[table])
            store.write(table, batch.where(only).select(*columns), batch_id)
            store.commit(spark, batch_id)

    return process


def start_unique_recent(
    readings: DataFrame, folder: str, delay: str = "1 hour", ddl: str = RAW_DDL, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Stream into a table keyed by time with the keys of the last `delay` in the state store.

    A batch costs what it holds, however large the table is. Copies that come within `delay` of the newest reading meet
    their key in the state; older rows, copies or not, fall behind the watermark and are counted as late. Keys behind the
    watermark leave the state. Rows without a time are left out.
    """
    store = unique_store(folder, ddl)
    store.create(readings.sparkSession)
    timed = readings.where(F.col("time").isNotNull()).withWatermark("time", delay)
    once = timed.dropDuplicatesWithinWatermark(["time"])
    return run_watched(once, stored(store, "readings"), folder, trigger, UNIQUE_METRICS, rows=F.count(F.lit(1)))


def read_unique(spark: SparkSession, folder: str, ddl: str = RAW_DDL) -> DataFrame:
    return unique_store(folder, ddl).read(spark, "readings")


def keyed_store(folder: str, series: str, kind: str = "string") -> Store:
    return Store(folder, {"processed_readings": f"{PROCESSED_DDL}, {series} {kind}"})


def start_keyed_features(
    readings: DataFrame, folder: str, series: str, delay: str = "0 seconds", trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Features of many series in one stream, the frames of each continuing from its last readings in the state store.

    `readings` has the raw columns and `series`. Readings not later than the watermark, `delay` behind the newest time of the
    batches before, are dropped by it; those not later than the newest reading of their own series are left out too. Both
    are counted as late, without a pass of their own.
    """
    spark = readings.sparkSession
    store = keyed_store(folder, series, readings.schema[series].dataType.simpleString())
    store.create(spark)
    full = with_row_features(keyed_frames(readings, series, delay))
    complete = ~F.col("late") & F.col("usage_ma_1h").isNotNull()
    with settings(spark, STORE_SETTINGS):
        return run_watched(
            full,
            stored(store, "processed_readings", "NOT late AND usage_ma_1h IS NOT NULL"),
            folder,
            trigger,
            FEATURE_METRICS,
            rows=F.count_if(complete),
            late=F.count_if("late"),
            anomalies=F.count_if(complete & F.col("z_anomaly")),
        )


def read_keyed(spark: SparkSession, folder: str, series: str, kind: str = "string") -> DataFrame:
    return keyed_store(folder, series, kind).read(spark, "processed_readings")


def start_publishing(processed: DataFrame, folder: str, trigger: Mapping[str, object] = PUBLISH_EVERY) -> StreamingQuery:
    """Stream of processed readings to message files; `publish_stream` sends the same rows to a broker."""
    return (
        encode(processed)
        .writeStream.format("parquet")
        .option("path", f"{folder}/messages")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
        .start()
    )


def start_preview(
    stream: DataFrame, sink: str = "console", rows: int = 5, trigger: Mapping[str, object] = ONCE, counts: str | None = None
) -> StreamingQuery:
    """Show the first rows of every batch untruncated; with `counts`, also write each batch's row count there."""
    if counts is None:
        shown = stream.writeStream.outputMode("append").format(sink).option("truncate", False).option("numRows", rows)
        return shown.trigger(**trigger).start()

    def process(batch: DataFrame, batch_id: int) -> None:
        if sink == "console":
            batch.show(rows, truncate=False)
        replace_metrics(batch.agg(F.count(F.lit(1)).alias("rows")), counts, batch_id)

    return run_batches(stream, process, f"{counts}-state", trigger)
