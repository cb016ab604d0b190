"""Every operator as a query over the test data: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnwatt.checks import testbed as tb
from kilnwatt.functions import calendar as cal
from kilnwatt.functions import measures as m
from kilnwatt.functions.text import day_first_time
from kilnwatt.operators import filters as flt
from kilnwatt.operators import joins, quality, quantiles, stats
from kilnwatt.operators import series as sr
from kilnwatt.plans import dashboard
from kilnwatt.plans import features as ft
from kilnwatt.schemas import (
    ANOMALY_DDL,
    COST_DDL,
    FEATURE_Z,
    LOAD_TYPES,
    PANEL_STEPS,
    PHYSICAL_BOUNDS,
    PROCESSED_DDL,
    RAW_COLUMNS,
    RAW_DDL,
    RAW_MESSAGE_DDL,
    SCORED_MESSAGE_DDL,
    STREAM_Z,
    TARIFFS,
)
from kilnwatt.session import fresh_path
from kilnwatt.sources import csv, tables, topic
from kilnwatt.streaming import jobs
from kilnwatt.streaming.progress import finish

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Cut small so that even the smallest test table spans several slots, range partitions and runs of positions.
FINE = sr.Layout(rows_per_task=300, chunk_rows=128)
FINE_POSITIONS = sr.Layout(rows_per_task=300, chunk_rows=128, hot_factor=0)
FINE_QUANTILES = {"bins": 3}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


MEANS = ("usage_ma_1h", "usage_ma_4h", "usage_ma_24h")


def rounded(df: DataFrame, digits: int = 6, only: tuple[str, ...] | None = None) -> DataFrame:
    """Round doubles for comparison, since sums of doubles depend on their order.

    Rounding a double is slow, so tables of whole rows name the columns that need it in `only`.
    A mean of 96 readings with two decimals can end in a 5 at the seventh, so that column keeps seven.
    """
    wanted = [c for c, kind in df.dtypes if kind == "double" and (only is None or c in only)]
    return df.withColumns({c: F.round(c, 7 if c == "usage_ma_24h" else digits) for c in wanted})


# --- sources, scans, sinks


@query
def src_csv(spark, sf):
    tb.readings(spark, sf)
    return csv.load_csv(spark, tb.source_csv(spark, sf))


@query
def norm_columns(spark, sf):
    return csv.normalise_names(tb.source_frame(spark, sf))


@query
def map_columns(spark, sf):
    return csv.to_readings(csv.normalise_names(tb.source_frame(spark, sf)).drop("co2tco2"))


@query
def parse_dayfirst(spark, sf):
    spelled = (
        F.when(F.col("load_type") == "Light_Load", F.date_format("time", "dd/MM/yyyy HH:mm"))
        .when(F.col("load_type") == "Medium_Load", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("unknown")
    )
    return tb.readings(spark, sf).select(spelled.alias("text")).withColumn("parsed", day_first_time(F.col("text")))


@query
def scan_ordered(spark, sf):
    return sr.sort_series(tb.readings(spark, sf))


def by_date(spark, df, label):
    """The readings as a table by date."""
    path = fresh_path(spark, label)
    tables.write_by_date(df, path)
    return path


@query
def scan_unprocessed(spark, sf):
    """The poll over tables by date: dates before the cursor are pruned on both sides."""
    raw, done = by_date(spark, tb.readings(spark, sf), "raw"), by_date(spark, tb.processed_part(spark, sf), "processed")
    read = lambda path: tables.read_by_date(spark, path, RAW_DDL)
    return joins.unprocessed(read(raw), read(done), tb.RESUME_AT).drop("date")


@query
def scan_unprocessed_bucketed(spark, sf):
    """The poll over tables bucketed alike by time: the join exchanges neither side."""
    frames = []
    for name, df in (("raw", tb.readings(spark, sf)), ("done", tb.processed_part(spark, sf))):
        path = fresh_path(spark, name)
        table = f"{name}_{path[-32:]}"
        tables.write_bucketed(df, table, path, buckets=8)
        frames.append(spark.table(table))
    return joins.unprocessed(*frames, tb.RESUME_AT)


@query
def scan_keyset(spark, sf):
    table = tables.read_by_date(spark, by_date(spark, tb.readings(spark, sf), "raw"), RAW_DDL)
    return joins.next_page(table, tb.RESUME_AT).drop("date")


@query
def cursor_init(spark, sf):
    """The newest processed time, from the newest date of the table alone."""
    return tables.newest_time(spark, by_date(spark, tb.processed_part(spark, sf), "processed"), RAW_DDL)


@query
def time_bounds_by_date(spark, sf):
    """First and last time, from the oldest and the newest date alone."""
    return tables.time_ends(spark, by_date(spark, tb.readings(spark, sf), "raw"), RAW_DDL)


@query
def stream_source(spark, sf):
    """Message files as a stream, decoded in the raw format and stored."""
    source, out = fresh_path(spark, "messages"), fresh_path(spark, "decoded")
    topic.publish_files(topic.encode(tb.readings(spark, sf)), source)
    rows = topic.decode(topic.read_message_files(spark, source), RAW_MESSAGE_DDL)
    run = rows.writeStream.format("parquet").option("checkpointLocation", f"{out}-state").trigger(availableNow=True)
    run.start(out).awaitTermination()
    return spark.read.schema(RAW_DDL).parquet(out)


@query
def decode_json(spark, sf):
    return topic.decode(topic.encode(tb.readings(spark, sf)), RAW_MESSAGE_DDL)


def spoilt(spark, sf):
    """All readings as messages; those of some meters are cut short, have no time, one that can't be read, or no value."""
    messages = tb.metered(tb.readings(spark, sf))
    spelt = topic.encode(messages.drop("meter").withColumn("_meter", F.col("lagging_reactive_power")))
    value, meter = F.col("value"), F.get_json_object("value", "$._meter").cast("double")
    bad = F.when(meter < 4, F.substring(value, 1, 40)).when(meter < 8, F.regexp_replace(value, '"time":"[^"]*"', '"time":null'))
    bad = bad.when(meter < 12, F.regexp_replace(value, '"time":"[^"]*"', '"time":"soon"')).when(meter < 16, F.regexp_replace(value, '"usage_kwh":[^,]*', '"usage_kwh":null'))
    return spelt.withColumn("value", bad.otherwise(value))


@query
def decode_dead_letters(spark, sf):
    """Stored readings and kept-back messages by reason: together, all messages."""
    folder = fresh_path(spark, "ingest")
    topic.publish_files(spoilt(spark, sf), f"{folder}/topic")
    finish(jobs.start_ingest(topic.read_message_files(spark, f"{folder}/topic"), folder))
    store = jobs.ingest_store(folder)
    good = store.read(spark, "readings").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("usage_kwh"), 4).alias("usage_kwh"))
    dead = store.read(spark, "dead_letters").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return good.withColumn("reason", F.lit("good")).unionByName(dead, allowMissingColumns=True)


@query
def encode_json(spark, sf):
    messages = topic.encode(tb.readings(spark, sf))
    return messages.select(
        "key",
        F.get_json_object("value", "$.time").alias("iso_time"),
        F.get_json_object("value", "$.usage_kwh").cast("double").alias("usage_kwh"),
        F.get_json_object("value", "$.load_type").alias("load_type"),
    )


@query
def sink_topic(spark, sf):
    out = fresh_path(spark, "topic")
    topic.publish_files(topic.encode(tb.row_features(spark, sf)), out)
    sent = topic.decode(spark.read.schema(topic.FILE_MESSAGES).parquet(out))
    return sent.select("time", "usage_kwh", "z_score", "z_anomaly", "tariff_period", "shift", "cost_tl")


@query
def sink_raw(spark, sf):
    out = fresh_path(spark, "raw")
    tables.write_by_date(tb.readings(spark, sf), out)
    return tables.read_by_date(spark, out, RAW_DDL)


@query
def sink_processed(spark, sf):
    out = fresh_path(spark, "processed")
    tables.write_processed(ft.processed_readings(tb.readings(spark, sf)), out)
    return rounded(tables.read_by_date(spark, out, PROCESSED_DDL), only=MEANS)


def scored_run(spark, sf, zone_mode="utc"):
    """Publish every reading with its row features, run the scoring stream once, return its folder."""
    folder = fresh_path(spark, "scoring")
    topic.publish_files(topic.encode(tb.row_features(spark, sf)), f"{folder}/topic")
    decoded = topic.decode(topic.read_message_files(spark, f"{folder}/topic"), SCORED_MESSAGE_DDL)
    finish(jobs.start_scoring(decoded, folder, zone_mode=zone_mode))
    return folder


@query
def sink_fanout(spark, sf):
    folder = scored_run(spark, sf)
    anomalies = jobs.read_anomalies(spark, folder).select("time", "usage_kwh", "z_score", "load_type")
    costs = jobs.read_costs(spark, folder).select("time", "usage_kwh", "tariff_type", "cost_tl", "load_type")
    return anomalies.withColumn("sink", F.lit("anomalies")).unionByName(
        costs.withColumn("sink", F.lit("cost_analysis")), allowMissingColumns=True
    )


@query
def sink_console(spark, sf):
    """The preview stream over all messages: how many rows its batches had, counted as each batch is shown."""
    source, counts = fresh_path(spark, "messages"), fresh_path(spark, "preview")
    topic.publish_files(topic.encode(tb.readings(spark, sf)), source)
    rows = topic.decode(topic.read_message_files(spark, source), RAW_MESSAGE_DDL, keep_null_time=True)
    jobs.start_preview(rows, sink="noop", counts=counts).awaitTermination()
    return spark.read.schema("rows bigint, batch_id bigint").parquet(counts).agg(F.sum("rows").alias("rows_seen"))


@query
def time_partitioned(spark, sf):
    out = fresh_path(spark, "dated")
    tables.write_by_date(tb.readings(spark, sf), out)
    table = tables.read_by_date(spark, out, RAW_DDL)
    return flt.in_time_range(table, tb.RESUME_AT, tb.SPLIT_AT).drop("date")


@query
def ingest_verify(spark, sf):
    return stats.ingest_report(tb.readings(spark, sf))


# --- derived columns


@query
def feat_calendar(spark, sf):
    parts = {**cal.calendar_parts(F.col("time")), "day_of_year": F.dayofyear("time")}
    return tb.readings(spark, sf).select("time", *[c.alias(n) for n, c in parts.items()])


@query
def feat_calendar_text(spark, sf):
    plain = tb.readings(spark, sf).select("time")
    return plain.withColumns(cal.calendar_text(F.col("time")))


@query
def feat_shift(spark, sf):
    return tb.readings(spark, sf).select("time", cal.shift_of(F.hour("time")).alias("shift"))


@query
def feat_tariff_period(spark, sf):
    return tb.readings(spark, sf).select("time", cal.tariff_of(F.hour("time")).alias("tariff_period"))


@query
def feat_day_period(spark, sf):
    return tb.readings(spark, sf).select("time", cal.day_period_of(F.hour("time")).alias("day_period"))


@query
def feat_power_factor(spark, sf):
    wide = ft.add_power_factor(tb.readings(spark, sf))
    return wide.select("time", "lagging_pf", "pf_efficiency", "reactive_power_balance", "low_pf_flag")


@query
def feat_zscore_fixed(spark, sf):
    both = {"z_feature": m.fixed_z(F.col("usage_kwh"), FEATURE_Z), "z_stream": m.fixed_z(F.col("usage_kwh"), STREAM_Z)}
    return tb.readings(spark, sf).select("time", "usage_kwh").withColumns(both)


@query
def feat_zscore_data(spark, sf):
    return rounded(stats.data_z(tb.readings(spark, sf).select("time", "usage_kwh")))


@query
def feat_cost(spark, sf):
    wide = ft.add_costs(ft.add_calendar(tb.readings(spark, sf)))
    return wide.select("time", "tariff_period", "cost_tl", "cost_if_night", "cost_saving")


@query
def stream_tariff_cost(spark, sf):
    scored = tb.scored(spark, sf)
    return scored.select("time", "usage_kwh", "hour", "tariff_type", "cost_tl", "z_score")


@query
def features_full(spark, sf):
    return rounded(ft.processed_readings(tb.readings(spark, sf)), only=MEANS)


@query
def features_analysis(spark, sf):
    return rounded(ft.analysis_features(tb.readings(spark, sf)), only=(*MEANS, "cumulative_daily", "z_score"))


@query
def project_rename(spark, sf):
    a = tb.anomalies(spark, sf)
    end = tb.newest(a)
    shown = dashboard.latest_anomalies(a, tb.SPLIT_AT, end, headings=dashboard.DETAIL_HEADINGS)
    return shown.withColumnRenamed("time", "Zaman")


@query
def clamp_range(spark, sf):
    plain = tb.readings(spark, sf)
    return plain.select(
        "time", *[m.clamp(F.col(c), low, high).alias(c) for c, (low, high) in PHYSICAL_BOUNDS.items()]
    )


@query
def threshold_band(spark, sf):
    a = tb.anomalies(spark, sf)
    colour = {
        "usage_band": m.band(F.col("usage_kwh"), PANEL_STEPS["details"]),
        "series_band": m.band(F.col("usage_kwh"), PANEL_STEPS["series"]),
        "z_band": m.band(F.abs("z_score"), PANEL_STEPS["mean_abs_z"]),
        "total_band": m.band(F.col("usage_kwh"), PANEL_STEPS["total_anomalies"]),
        "hours_band": m.band(F.col("z_score"), PANEL_STEPS["hours_since"]),
    }
    return a.select("time", "usage_kwh", *[c.alias(n) for n, c in colour.items()])


# --- filters


@query
def flt_spike_or_drop(spark, sf):
    return tb.row_features(spark, sf).where("z_anomaly").select("time", "usage_kwh", "z_score", "load_type")


@query
def flt_two_sided(spark, sf):
    scored = stats.data_z(tb.readings(spark, sf).select("time", "usage_kwh"))
    return rounded(scored.where(m.two_sided(F.col("z_score"))))


@query
def flt_iqr(spark, sf):
    return flt.iqr_outliers(tb.readings(spark, sf).select("time", "usage_kwh", "load_type"))


@query
def flt_route_anomalies(spark, sf):
    return flt.route_anomalies(tb.scored(spark, sf))


@query
def flt_route_cost(spark, sf):
    return flt.route_costs(tb.scored(spark, sf))


@query
def flt_time_notnull(spark, sf):
    """Messages of which the maximum-load ones carry an unreadable time."""
    broken = F.when(F.col("load_type") == "Maximum_Load", F.lit("garbage")).otherwise(F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    sent = tb.readings(spark, sf).withColumn("time", broken)
    messages = sent.select(F.to_json(F.struct(*RAW_COLUMNS)).alias("value"))
    return topic.decode(messages, RAW_MESSAGE_DDL).select("time", "usage_kwh", "load_type")


@query
def flt_dropna(spark, sf):
    rolled = ft.add_rolling(tb.readings(spark, sf))
    return rounded(flt.drop_incomplete(rolled).select("time", "usage_ma_1h"))


@query
def flt_time_range(spark, sf):
    plain = tb.readings(spark, sf)
    as_of = tb.newest(plain)
    return flt.newer_than(flt.in_time_range(plain, tb.SPLIT_AT, as_of), as_of, "6 hours").select("time", "usage_kwh")


@query
def flt_load_type_in(spark, sf):
    return flt.with_load_types(tb.readings(spark, sf), ["Light_Load", "Maximum_Load"]).select("time", "load_type")


# --- joins


@query
def join_left_anti(spark, sf):
    return joins.not_in(tb.readings(spark, sf), tb.processed_part(spark, sf))


@query
def join_scalar_stats(spark, sf):
    plain = tb.readings(spark, sf).select("time", "usage_kwh")
    own = joins.with_scalar(stats.usage_stats(plain).select("mean", "std"), flt.iqr_fences(plain).select("q1", "q3"))
    return rounded(joins.with_scalar(plain, own))


@query
def join_day_dimension(spark, sf):
    """Mean by weekday of all readings, a day without any (here staged: Sunday) kept with a null."""
    means = tb.readings(spark, sf).groupBy("day_of_week").agg(F.avg("usage_kwh").alias("mean_usage"))
    return rounded(joins.in_weekday_order(means.where(F.col("day_of_week") != "Sunday")).select("day_order", "day_of_week", "mean_usage"))


@query
def join_date_spine(spark, sf):
    """Daily consumption of all readings on a calendar without gaps; days without any are staged: the weekends."""
    daily = tb.readings(spark, sf).groupBy(F.to_date("time").alias("day")).agg(F.sum("usage_kwh").alias("total_usage"))
    return rounded(joins.on_date_spine(daily.where(F.weekday("day") < 5)), 4)


@query
def join_insert_ignore(spark, sf):
    """All readings, each delivered twice, against a table that holds the light-load ones."""
    plain = tb.readings(spark, sf)
    return joins.insert_ignore(plain.unionAll(plain), tb.processed_part(spark, sf))


@query
def join_table_lag(spark, sf):
    return rounded(joins.table_lag(tb.readings(spark, sf), tb.processed_part(spark, sf)))


# --- aggregates


def panel_range(spark, sf):
    a = tb.anomalies(spark, sf)
    return a, tb.SPLIT_AT, tb.newest(a)


@query
def agg_count(spark, sf):
    a, start, end = panel_range(spark, sf)
    shown = dashboard.total_anomalies(a, start, end, ["Light_Load"])
    return joins.with_scalar(stats.row_count(tb.readings(spark, sf), "total_rows"), shown)


@query
def agg_time_bounds(spark, sf):
    return stats.time_bounds(tb.readings(spark, sf))


@query
def agg_count_by_load(spark, sf):
    a, start, end = panel_range(spark, sf)
    return dashboard.anomalies_by_load(a, start, end)


@query
def agg_share_by_load(spark, sf):
    return stats.share_by(tb.readings(spark, sf))


@query
def agg_describe(spark, sf):
    return stats.describe(tb.readings(spark, sf))


@query
def agg_usage_stats(spark, sf):
    return rounded(stats.usage_stats(tb.readings(spark, sf)))


def by_hour(spark, sf):
    return stats.mean_by(tb.readings(spark, sf).withColumn("hour", F.hour("time")), "hour")


@query
def agg_hourly_mean(spark, sf):
    return rounded(by_hour(spark, sf))


@query
def agg_peak_hour(spark, sf):
    return rounded(stats.peak_and_trough(by_hour(spark, sf)))


@query
def agg_weekday_mean(spark, sf):
    return rounded(stats.weekday_mean(tb.readings(spark, sf)))


@query
def agg_week_status(spark, sf):
    return stats.moments_by(tb.readings(spark, sf))


@query
def agg_shift_mean(spark, sf):
    return rounded(stats.mean_by(ft.add_calendar(tb.readings(spark, sf)), "shift"))


@query
def agg_month_mean(spark, sf):
    return rounded(stats.mean_by(ft.add_calendar(tb.readings(spark, sf)), "month"))


@query
def agg_tariff_cost(spark, sf):
    costed = ft.add_costs(ft.add_calendar(tb.readings(spark, sf)))
    return rounded(stats.sum_by(costed, "tariff_period", "cost_tl", "total_cost"), 4)


@query
def agg_savings(spark, sf):
    return rounded(stats.savings(ft.add_costs(ft.add_calendar(tb.readings(spark, sf)))), 4)


@query
def agg_daily_resample(spark, sf):
    return rounded(stats.daily_resample(tb.readings(spark, sf)))


@query
def agg_hot_days(spark, sf):
    return rounded(stats.hot_days(tb.readings(spark, sf)))


@query
def agg_hot_days_wide(spark, sf):
    """Every day above one deviation, without the top-ten limit."""
    return rounded(stats.hot_days(tb.readings(spark, sf), deviations=1.0, limit=None))


@query
def agg_quantiles(spark, sf):
    return rounded(stats.quartiles(tb.readings(spark, sf)))


@query
def agg_quantiles_bounded(spark, sf):
    """The same quartiles with so few bins that many passes are needed, as on a table with many different values."""
    return rounded(stats.quartiles(tb.readings(spark, sf), **FINE_QUANTILES))


@query
def agg_quantiles_sketch(spark, sf):
    """Quantiles from sketches stored per date: is the rank of each within a hundredth of the rows of the one asked for?"""
    plain = tb.readings(spark, sf)
    stored = fresh_path(spark, "sketches")
    quantiles.quantile_sketches(plain.withColumn("date", F.to_date("time")), "usage_kwh", "date").write.parquet(stored)
    found = quantiles.sketched_quantiles(spark.read.parquet(stored), [0.05, 0.25, 0.5, 0.75, 0.95])
    ranked = plain.where("usage_kwh IS NOT NULL").crossJoin(F.broadcast(found)).groupBy("p").agg(
        F.avg((F.col("usage_kwh") < F.col("quantile")).cast("double")).alias("below"), F.avg((F.col("usage_kwh") <= F.col("quantile")).cast("double")).alias("up_to")
    )
    return ranked.select("p", ((F.col("below") - 0.01 <= F.col("p")) & (F.col("p") <= F.col("up_to") + 0.01)).alias("within"))


@query
def agg_iqr_summary(spark, sf):
    return rounded(stats.iqr_summary(tb.readings(spark, sf)))


@query
def agg_histogram(spark, sf):
    wide = ft.add_power_factor(tb.readings(spark, sf))
    usage = stats.histogram(wide, "usage_kwh", 50).withColumn("measure", F.lit("usage_kwh"))
    pf = stats.histogram(wide, "pf_efficiency", 30).withColumn("measure", F.lit("pf_efficiency"))
    return rounded(usage.unionByName(pf))


@query
def agg_boxplot(spark, sf):
    return rounded(stats.boxplot(tb.readings(spark, sf)))


@query
def agg_anomaly_summary(spark, sf):
    return rounded(stats.anomaly_summary(tb.readings(spark, sf)))


@query
def agg_feature_rates(spark, sf):
    return rounded(stats.feature_rates(tb.row_features(spark, sf)))


@query
def agg_mean_abs_z(spark, sf):
    return dashboard.mean_abs_z(*panel_range(spark, sf))


@query
def agg_max_usage(spark, sf):
    return dashboard.max_usage(*panel_range(spark, sf), ["Light_Load", "Medium_Load"])


@query
def agg_hours_since(spark, sf):
    """Hours from the last anomaly to the newest reading."""
    return dashboard.hours_since_last(tb.anomalies(spark, sf), tb.newest(tb.readings(spark, sf)))


@query
def agg_filter_rate(spark, sf):
    wide = tb.row_features(spark, sf)
    return rounded(stats.flagged_rate(flt.newer_than(wide, tb.newest(wide), "1 day")))


@query
def agg_null_profile(spark, sf):
    """Readings whose maximum-load rows lost their power factor."""
    lost = F.when(F.col("load_type") != "Maximum_Load", F.col("lagging_pf"))
    return stats.null_profile(tb.readings(spark, sf).withColumn("lagging_pf", lost))


@query
def agg_distinct(spark, sf):
    loads = stats.distinct_values(tb.readings(spark, sf), "load_type").select(F.lit("load_type").alias("field"), F.col("load_type").alias("value"))
    tariffs = stats.distinct_values(tb.costs(spark, sf), "tariff_type").select(F.lit("tariff_type").alias("field"), F.col("tariff_type").alias("value"))
    return loads.unionAll(tariffs)


@query
def agg_shape(spark, sf):
    return stats.shape(tb.row_features(spark, sf), len(RAW_COLUMNS))


@query
def agg_batch_metrics(spark, sf):
    folder = scored_run(spark, sf)
    return jobs.read_metrics(spark, folder, jobs.SCORE_METRICS)


# --- windows


def rolled(spark, sf, name, rows, layout=sr.DEFAULT_LAYOUT):
    plain = tb.readings(spark, sf).select("time", "usage_kwh")
    made = sr.over_series(plain, lambda w: {name: sr.trailing_mean("usage_kwh", rows, w)}, rows - 1, ["usage_kwh"], layout=layout)
    return rounded(made)


@query
def win_ma_4(spark, sf):
    return rolled(spark, sf, "usage_ma_1h", 4)


@query
def win_ma_16(spark, sf):
    return rolled(spark, sf, "usage_ma_4h", 16)


@query
def win_ma_96(spark, sf):
    return rolled(spark, sf, "usage_ma_24h", 96)


@query
def win_diff(spark, sf):
    plain = tb.readings(spark, sf).select("time", "usage_kwh")
    return sr.over_series(plain, lambda w: {"usage_diff": sr.change("usage_kwh", w)}, 1, ["usage_kwh"])


@query
def win_pct_change(spark, sf):
    plain = tb.readings(spark, sf).select("time", "usage_kwh")
    return sr.over_series(plain, lambda w: {"usage_pct_change": sr.percent_change("usage_kwh", w)}, 1, ["usage_kwh"])


def summed_by_date(spark, sf, layout=sr.DEFAULT_LAYOUT):
    plain = tb.readings(spark, sf).select("time", "usage_kwh")
    return rounded(sr.running_sum_by_date(plain, layout=layout), 4, only=("cumulative_daily",))


@query
def win_cum_daily(spark, sf):
    return summed_by_date(spark, sf)


@query
def win_cum_daily_split(spark, sf):
    """The daily running sum as it runs when one date is too big for a task."""
    return summed_by_date(spark, sf, FINE_POSITIONS)


def all_rolled(spark, sf, layout):
    plain = tb.readings(spark, sf).select("time", "usage_kwh")
    return rounded(ft.add_rolling(plain, day_frame=True, layout=layout), only=MEANS)


@query
def win_slot_halo(spark, sf):
    """All rolling columns over time slots with halos, whatever the size."""
    return all_rolled(spark, sf, FINE)


@query
def win_indexed_halo(spark, sf):
    """All rolling columns over runs of positions with halos, as for a series with a crowded time."""
    return all_rolled(spark, sf, FINE_POSITIONS)


@query
def win_pct_change_padded(spark, sf):
    """Percentage change with the gaps (here: maximum-load readings) filled from the last known value first."""
    known = F.when(F.col("load_type") != "Maximum_Load", F.col("usage_kwh"))
    plain = tb.readings(spark, sf).select("time", known.alias("usage_kwh"))
    return ft.add_rolling(plain, fill="pad", layout=FINE).select("time", "usage_pct_change")


# --- sort, limit, sets


@query
def topk_latest_anomalies(spark, sf):
    return dashboard.latest_anomalies(*panel_range(spark, sf))


@query
def sort_anomaly_series(spark, sf):
    return dashboard.anomaly_series(*panel_range(spark, sf))


@query
def sort_series(spark, sf):
    return sr.sort_series(tb.readings(spark, sf).select("time", "usage_kwh"))


@query
def limit_head(spark, sf):
    scored = stats.data_z(tb.readings(spark, sf).select("time", "usage_kwh", "load_type"))
    return rounded(scored.where(m.two_sided(F.col("z_score"))).orderBy("time").limit(10))


@query
def set_enum_violations(spark, sf):
    loads = quality.outside_enum(tb.readings(spark, sf), "load_type", LOAD_TYPES[:2]).toDF("violation")
    tariffs = quality.outside_enum(tb.costs(spark, sf), "tariff_type", TARIFFS).toDF("violation")
    return loads.unionAll(tariffs)


# --- data quality


# Columns of the given tables that the library reads.
GIVEN = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_totalprice double",
    "region": "r_regionkey bigint, r_name string",
    "nation": "n_nationkey bigint, n_name string, n_regionkey bigint, n_usage_kwh double",
}


def written(spark, name, rows, path, ddl):
    """Write a table by date; one without rows is still a table."""
    write = tables.write_processed if name == "processed" else tables.write_by_date
    if not write(rows, path):
        spark.createDataFrame([], ddl).write.mode("append").parquet(path)
    return path, ddl


@query
def dq_tables_exist(spark, sf):
    """The library's four tables, written from the test data and looked up with their columns; a narrow and a missing
    one; and the given tables with the columns wanted of them, one of which isn't there."""
    folder, plain = fresh_path(spark, "store"), tb.readings(spark, sf)
    made = {
        "raw": (plain, RAW_DDL),
        "processed": (ft.processed_readings(plain), PROCESSED_DDL),
        "anomalies": (tb.anomalies(spark, sf), ANOMALY_DDL),
        "costs": (tb.costs(spark, sf), COST_DDL),
        "narrow": (plain.select("time", "usage_kwh"), "time timestamp, usage_kwh double"),
    }
    wanted = {n: written(spark, n, rows, f"{folder}/{n}", ddl) for n, (rows, ddl) in made.items()}
    wanted |= {n: (f"{folder}/{n}", COST_DDL) for n in ("narrow", "missing")}
    return quality.tables_exist(spark, wanted | {n: (f"{sf}/{n}.parquet", ddl) for n, ddl in GIVEN.items()})


@query
def dq_non_empty(spark, sf):
    return quality.non_empty(
        {
            "energy_readings": tb.readings(spark, sf),
            "processed_readings": tb.processed_part(spark, sf),
            "anomalies": tb.anomalies(spark, sf),
            "cost_analysis": tb.costs(spark, sf),
        }
    )


def recent_check(check, spark, sf):
    plain = tb.readings(spark, sf)
    return check(plain, tb.newest(plain))


@query
def dq_freshness(spark, sf):
    return recent_check(quality.fresh_rows, spark, sf)


@query
def dq_usage_range(spark, sf):
    return recent_check(quality.usage_in_range, spark, sf)


@query
def dq_load_type_enum(spark, sf):
    return quality.load_types_valid(tb.readings(spark, sf))


@query
def dq_time_not_null(spark, sf):
    return quality.time_not_null(tb.readings(spark, sf))


@query
def dq_anomaly_rate(spark, sf):
    wide = tb.row_features(spark, sf)
    return rounded(quality.anomaly_rate_ok(wide, tb.newest(wide)))


@query
def dq_tariff_enum(spark, sf):
    return quality.tariffs_valid(tb.costs(spark, sf))


@query
def dq_anomaly_z(spark, sf):
    return quality.anomaly_z_large(tb.anomalies(spark, sf))


@query
def dq_pipeline_lag(spark, sf):
    return rounded(quality.processing_lag_ok(tb.readings(spark, sf), tb.processed_part(spark, sf)))


@query
def dq_message_fields(spark, sf):
    """Messages of both formats: with features, and the raw ones that are passed over."""
    current, old = topic.encode(tb.row_features(spark, sf)), topic.encode(tb.readings(spark, sf))
    return quality.message_fields(current.unionAll(old))


# --- streams


@query
def st_enrich(spark, sf):
    return jobs.read_costs(spark, scored_run(spark, sf)).drop("batch_id")


@query
def st_trigger(spark, sf):
    """The scoring job started twice on one checkpoint: the second start finds nothing new."""
    folder = scored_run(spark, sf)
    again = topic.decode(topic.read_message_files(spark, f"{folder}/topic"), SCORED_MESSAGE_DDL)
    finish(jobs.start_scoring(again, folder))
    return jobs.read_anomalies(spark, folder).select("time", "usage_kwh", "z_score", "load_type")


@query
def st_empty_guard(spark, sf):
    """A batch of unreadable messages leaves no trace beside the batch of good ones."""
    folder = scored_run(spark, sf)
    broken = topic.encode(tb.row_features(spark, sf)).select("key", F.lit("{broken").alias("value"))
    topic.publish_files(broken, f"{folder}/topic")
    decoded = topic.decode(topic.read_message_files(spark, f"{folder}/topic"), SCORED_MESSAGE_DDL)
    finish(jobs.start_scoring(decoded, folder))
    return stats.count_by(jobs.read_costs(spark, folder), "batch_id")


def delivered(spark, sf, start, prepare=lambda df: df):
    """Run a stream job once per delivery, on one checkpoint."""
    folder = fresh_path(spark, "deliveries")
    for delivery in tb.arrivals(spark, sf):
        rows = prepare(delivery)
        rows.write.mode("append").parquet(f"{folder}/in")
        finish(start(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), folder))
    return folder


@query
def st_poll_features(spark, sf):
    """Features by stream over two deliveries, the frames continuing from one to the next."""
    folder = delivered(spark, sf, lambda s, f: jobs.start_features(s, f, jobs.ONCE))
    return rounded(jobs.read_processed(spark, folder).drop("batch_id", "date"), only=MEANS)


def metered_run(spark, sf):
    return delivered(spark, sf, lambda s, f: jobs.start_keyed_features(s, f, "meter"), tb.metered)


@query
def st_keyed_features(spark, sf):
    """Features of eighty meters over two deliveries, each meter's frames continuing in the state store."""
    folder = metered_run(spark, sf)
    return rounded(jobs.read_keyed(spark, folder, "meter", "bigint").drop("batch_id", "date"), only=MEANS)


@query
def st_late_data(spark, sf):
    """Rows taken and left out as late, per delivery, as the query's progress tells them."""
    metrics = jobs.read_metrics(spark, metered_run(spark, sf), jobs.FEATURE_METRICS)
    # A batch without data may run between the deliveries, to move the watermark on.
    return metrics.withColumn("batch_id", (F.row_number().over(Window.orderBy("batch_id")) - 1).cast("bigint"))


@query
def st_late_single(spark, sf):
    """The same of the job over one series, which leaves out what isn't later than its newest reading."""
    folder = delivered(spark, sf, lambda s, f: jobs.start_features(s, f, jobs.ONCE))
    return jobs.read_feature_counts(spark, folder)


@query
def st_poll_publish(spark, sf):
    """Processed readings read as a stream and published as messages."""
    folder = fresh_path(spark, "publishing")
    ft.processed_readings(tb.readings(spark, sf)).write.parquet(f"{folder}/in")
    jobs.start_publishing(spark.readStream.schema(PROCESSED_DDL).parquet(f"{folder}/in"), folder, jobs.ONCE).awaitTermination()
    return rounded(topic.decode(spark.read.schema(topic.FILE_MESSAGES).parquet(f"{folder}/messages")), only=MEANS)


def replayed(spark, sf, start):
    """Run a stream job on all readings, and again on a replay of them."""
    folder = fresh_path(spark, "unique")
    for _ in range(2):
        tb.readings(spark, sf).write.mode("append").parquet(f"{folder}/in")
        finish(start(spark.readStream.schema(RAW_DDL).parquet(f"{folder}/in"), folder))
    return folder


@query
def st_dedup(spark, sf):
    """All readings delivered twice, the second time by a replay; recent keys are in the state store."""
    return jobs.read_unique(spark, replayed(spark, sf, jobs.start_unique_recent)).drop("batch_id", "date")


@query
def st_dedup_keyed(spark, sf):
    """The same by keyed inserts, against all that is stored."""
    return tables.read_by_date(spark, f"{replayed(spark, sf, jobs.start_unique)}/readings", RAW_DDL).drop("date")


@query
def st_compact(spark, sf):
    """The scored anomalies after a stream of twelve files, one to a batch, whose batches were merged meanwhile."""
    folder = fresh_path(spark, "compacted")
    parts = tb.row_features(spark, sf).repartitionByRange(12, "time")
    topic.publish_files(topic.encode(parts), f"{folder}/topic")
    decoded = topic.decode(topic.read_message_files(spark, f"{folder}/topic", files_per_batch=1), SCORED_MESSAGE_DDL)
    finish(jobs.start_scoring(decoded, folder))
    store = replace(jobs.scores(folder), fan=4)
    store.compact(spark)
    store.clean(spark, keep=0)
    return jobs.read_anomalies(spark, folder).select("time", "usage_kwh", "z_score", "load_type")
