"""The same queries as plain SQL over the test tables, written independently of the Spark plans."""

from __future__ import annotations

# Named steps; each may use the ones before it.
STEPS = {
    "r": """
        SELECT ts AS time, value AS usage_kwh,
          CAST(user_id % 80 AS DOUBLE) AS lagging_reactive_power, CAST(event_id % 20 AS DOUBLE) AS leading_reactive_power,
          CAST(event_id % 80 AS DOUBLE) / CAST(1000 AS DOUBLE) AS co2_tco2,
          CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS lagging_pf,
          CAST((event_id * 7) % 101 AS DOUBLE) AS leading_pf,
          CAST(hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS INT) AS nsm,
          CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS week_status,
          dayname(ts) AS day_of_week,
          CASE event_type WHEN 'purchase' THEN 'Maximum_Load' WHEN 'error' THEN 'Medium_Load'
            WHEN 'signup' THEN 'Medium_Load' ELSE 'Light_Load' END AS load_type
        FROM events""",
    "c": """
        SELECT *, CAST(hour(time) AS INT) AS hour, CAST(day(time) AS INT) AS day, CAST(month(time) AS INT) AS month,
          CAST(quarter(time) AS INT) AS quarter, isodow(time) >= 6 AS is_weekend,
          CASE WHEN hour(time) < 8 THEN 'night_shift' WHEN hour(time) < 16 THEN 'day_shift' ELSE 'evening_shift' END AS shift,
          CASE WHEN hour(time) >= 22 OR hour(time) < 6 THEN 'night' ELSE 'day' END AS tariff_period,
          CASE WHEN hour(time) < 6 THEN 'midnight' WHEN hour(time) < 12 THEN 'morning'
            WHEN hour(time) < 18 THEN 'afternoon' ELSE 'evening' END AS day_period
        FROM r""",
    "f": """
        SELECT *, (lagging_pf + leading_pf) / 2 AS pf_efficiency,
          lagging_reactive_power - leading_reactive_power AS reactive_power_balance, lagging_pf < 80 AS low_pf_flag,
          (usage_kwh - CAST(27.39 AS DOUBLE)) / CAST(33.44 AS DOUBLE) AS z_score,
          (usage_kwh - CAST(27.39 AS DOUBLE)) / CAST(33.44 AS DOUBLE) > 3 OR usage_kwh < 2 AS z_anomaly,
          usage_kwh * CASE WHEN tariff_period = 'night' THEN CAST(1.8 AS DOUBLE) ELSE CAST(3.2 AS DOUBLE) END AS cost_tl,
          usage_kwh * CAST(1.8 AS DOUBLE) AS cost_if_night,
          usage_kwh * CASE WHEN tariff_period = 'night' THEN CAST(1.8 AS DOUBLE) ELSE CAST(3.2 AS DOUBLE) END
            - usage_kwh * CAST(1.8 AS DOUBLE) AS cost_saving
        FROM c""",
    "w": """
        SELECT *,
          CASE WHEN count(usage_kwh) OVER (ORDER BY time ROWS 3 PRECEDING) = 4
            THEN avg(usage_kwh) OVER (ORDER BY time ROWS 3 PRECEDING) END AS usage_ma_1h,
          CASE WHEN count(usage_kwh) OVER (ORDER BY time ROWS 15 PRECEDING) = 16
            THEN avg(usage_kwh) OVER (ORDER BY time ROWS 15 PRECEDING) END AS usage_ma_4h,
          CASE WHEN count(usage_kwh) OVER (ORDER BY time ROWS 95 PRECEDING) = 96
            THEN avg(usage_kwh) OVER (ORDER BY time ROWS 95 PRECEDING) END AS usage_ma_24h,
          usage_kwh - lag(usage_kwh) OVER (ORDER BY time) AS usage_diff,
          (usage_kwh - lag(usage_kwh) OVER (ORDER BY time)) / nullif(lag(usage_kwh) OVER (ORDER BY time), 0) * 100
            AS usage_pct_change
        FROM {series}""",
    "s": """
        SELECT time, usage_kwh, load_type, z_anomaly,
          (usage_kwh - CAST(35.2 AS DOUBLE)) / CAST(27.8 AS DOUBLE) AS z_score,
          CAST(epoch_us(time) // 1000000 % 86400 AS DOUBLE) / 3600 AS hour
        FROM f""",
    "t": """
        SELECT *, CASE WHEN hour >= 22 OR hour < 6 THEN 'night' ELSE 'day' END AS tariff_type,
          usage_kwh * CASE WHEN hour >= 22 OR hour < 6 THEN CAST(1.8 AS DOUBLE) ELSE CAST(3.2 AS DOUBLE) END AS cost_tl
        FROM s""",
    "a": "SELECT time, usage_kwh, z_score, load_type, time AS detected_at FROM t WHERE z_anomaly",
    "k": "SELECT time, usage_kwh, tariff_type, cost_tl, load_type FROM t WHERE cost_tl IS NOT NULL",
    "p": "SELECT * FROM r WHERE load_type = 'Light_Load'",
    "q": """
        SELECT quantile_cont(usage_kwh, 0.25) AS q1, quantile_cont(usage_kwh, 0.5) AS median,
          quantile_cont(usage_kwh, 0.75) AS q3 FROM r""",
    "e": """
        SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lower, q3 + 1.5::DOUBLE * (q3 - q1) AS upper
        FROM q""",
    "m": "SELECT avg(usage_kwh) AS mean, stddev_samp(usage_kwh) AS std, min(usage_kwh) AS min, max(usage_kwh) AS max FROM r",
    "z": "SELECT r.*, (usage_kwh - m.mean) / m.std AS z_score FROM r, m",
    "d": "SELECT CAST(time AS DATE) AS day, avg(usage_kwh) AS mean_usage FROM r GROUP BY 1",
    "panel": """
        SELECT * FROM a WHERE time BETWEEN TIMESTAMP '2024-01-16' AND (SELECT max(time) FROM a)""",
    "sorted_out": """
        SELECT usage_kwh, CASE WHEN lagging_reactive_power < 4 THEN 'unreadable' WHEN lagging_reactive_power < 8 THEN 'time missing'
          WHEN lagging_reactive_power < 12 THEN 'time unreadable'
          WHEN lagging_reactive_power < 16 OR usage_kwh IS NULL THEN 'field missing' END AS reason FROM r""",
    "first_delivery": "SELECT * FROM r WHERE time < TIMESTAMP '2024-01-16' AND load_type <> 'Maximum_Load'",
    "second_delivery": "SELECT * FROM r WHERE time >= TIMESTAMP '2024-01-16' OR load_type = 'Maximum_Load'",
    "taken": """
        SELECT * FROM first_delivery UNION ALL
        SELECT * FROM second_delivery WHERE time > (SELECT max(time) FROM first_delivery)""",
}
RAW = (
    "time, usage_kwh, lagging_reactive_power, leading_reactive_power, co2_tco2, lagging_pf, leading_pf, nsm, "
    "week_status, day_of_week, load_type"
)
PROCESSED = f"""{RAW}, hour, day, month, quarter, is_weekend, shift, tariff_period, day_period,
    round(usage_ma_1h, 6) AS usage_ma_1h, round(usage_ma_4h, 6) AS usage_ma_4h, usage_diff, usage_pct_change, pf_efficiency, reactive_power_balance, low_pf_flag,
    z_score, z_anomaly, cost_tl, cost_saving"""

ORACLE: dict[str, str] = {}


def twin(name: str, *steps: str, series: str = "f", **extra: str):
    """Register `WITH <steps> <query>`; the last positional argument is the query."""
    *names, body = steps
    with_steps = [f"{n} AS ({STEPS[n].format(series=series)})" for n in names]
    with_steps += [f"{n} AS ({sql})" for n, sql in extra.items()]
    ORACLE[name] = (f"WITH {', '.join(with_steps)} " if with_steps else "") + body


def dec(expression: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


# --- sources, scans, sinks
MINUTES = RAW.replace("time,", "date_trunc('minute', time) AS time,", 1)
twin("src_csv", "r", f"SELECT {MINUTES} FROM r")
twin("norm_columns", "r", """
    SELECT strftime(time, '%d/%m/%Y %H:%M') AS date, usage_kwh,
      lagging_reactive_power AS lagging_current_reactive_power_kvarh,
      leading_reactive_power AS leading_current_reactive_power_kvarh, co2_tco2 AS co2tco2,
      lagging_pf AS lagging_current_power_factor, leading_pf AS leading_current_power_factor, nsm,
      week_status AS weekstatus, day_of_week, load_type FROM r""")
twin("map_columns", "r", f"SELECT {MINUTES.replace('co2_tco2,', 'CAST(NULL AS DOUBLE) AS co2_tco2,')} FROM r")
twin("parse_dayfirst", "r", """
    SELECT CASE load_type WHEN 'Light_Load' THEN strftime(time, '%d/%m/%Y %H:%M')
        WHEN 'Medium_Load' THEN strftime(time, '%Y-%m-%d %H:%M:%S') ELSE 'unknown' END AS text,
      CASE load_type WHEN 'Light_Load' THEN date_trunc('minute', time)
        WHEN 'Medium_Load' THEN date_trunc('second', time) END AS parsed FROM r""")
for whole in ("scan_ordered", "stream_source", "decode_json"):
    twin(whole, "r", f"SELECT {RAW} FROM r ORDER BY time")
twin("scan_unprocessed", "r", "p", f"""
    SELECT {RAW} FROM r WHERE time NOT IN (SELECT time FROM p) AND time > TIMESTAMP '2024-01-10' ORDER BY time LIMIT 500""")
twin("scan_keyset", "r", f"SELECT {RAW} FROM r WHERE time > TIMESTAMP '2024-01-10' ORDER BY time LIMIT 100")
twin("cursor_init", "r", "p", "SELECT coalesce(max(time), TIMESTAMP '2000-01-01') AS cursor FROM p")
FRACTION = "CASE WHEN epoch_us(time) % 1000000 = 0 THEN '' ELSE strftime(time, '.%f') END || '+00:00'"
twin("encode_json", "r", f"""
    SELECT strftime(time, '%Y-%m-%d %H:%M:%S') || {FRACTION} AS key,
      strftime(time, '%Y-%m-%dT%H:%M:%S') || {FRACTION} AS iso_time, usage_kwh, load_type FROM r""")
twin("sink_topic", "r", "c", "f", """
    SELECT time, usage_kwh, z_score, z_anomaly, tariff_period, shift, cost_tl FROM f""")
twin("sink_raw", "r", f"SELECT {RAW}, CAST(time AS DATE) AS date FROM r")
twin("sink_processed", "r", "c", "f", "w",
     f"SELECT {PROCESSED}, CAST(time AS DATE) AS date FROM w WHERE usage_ma_1h IS NOT NULL")
twin("sink_fanout", "r", "c", "f", "s", "t", "a", "k", """
    SELECT 'anomalies' AS sink, time, usage_kwh, z_score, load_type, NULL AS tariff_type, NULL AS cost_tl FROM a
    UNION ALL SELECT 'cost_analysis', time, usage_kwh, NULL, load_type, tariff_type, cost_tl FROM k""")
twin("sink_console", "SELECT CAST(count(*) AS BIGINT) AS rows_seen FROM events")
twin("time_partitioned", "r", f"SELECT {RAW} FROM r WHERE time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-16'")
twin("ingest_verify", "r", """
    SELECT load_type, count(*) AS rows, (SELECT count(*) FROM r) AS total_rows, (SELECT min(time) FROM r) AS first_time,
      (SELECT max(time) FROM r) AS last_time FROM r GROUP BY 1 ORDER BY 2 DESC, 1""")

# --- derived columns
twin("feat_calendar", "r", "c", """
    SELECT time, hour, day, month, quarter, is_weekend, CAST(dayofyear(time) AS INT) AS day_of_year FROM c""")
twin("feat_calendar_text", "r", "SELECT time, nsm, day_of_week, week_status FROM r")
for column in ("shift", "tariff_period", "day_period"):
    twin(f"feat_{column}", "r", "c", f"SELECT time, {column} FROM c")
twin("feat_power_factor", "r", "c", "f", "SELECT time, lagging_pf, pf_efficiency, reactive_power_balance, low_pf_flag FROM f")
twin("feat_zscore_fixed", "r", """
    SELECT time, usage_kwh, (usage_kwh - CAST(27.39 AS DOUBLE)) / CAST(33.44 AS DOUBLE) AS z_feature,
      (usage_kwh - CAST(35.2 AS DOUBLE)) / CAST(27.8 AS DOUBLE) AS z_stream FROM r""")
twin("feat_zscore_data", "r", "m", "z", "SELECT time, usage_kwh, round(z_score, 6) AS z_score FROM z")
twin("feat_cost", "r", "c", "f", """
    SELECT time, tariff_period, cost_tl, cost_if_night, cost_saving FROM f""")
twin("stream_tariff_cost", "r", "c", "f", "s", "t", """
    SELECT time, usage_kwh, hour, tariff_type, cost_tl, z_score FROM t""")
twin("features_full", "r", "c", "f", "w", f"SELECT {PROCESSED} FROM w WHERE usage_ma_1h IS NOT NULL")
twin("features_analysis", "r", "c", "f", "w", "q", "e", "m", f"""
    SELECT {RAW}, hour, day, month, quarter, is_weekend, shift, tariff_period, day_period, pf_efficiency,
      reactive_power_balance, low_pf_flag, CAST(dayofyear(time) AS INT) AS day_of_year,
      round(usage_ma_1h, 6) AS usage_ma_1h, round(usage_ma_4h, 6) AS usage_ma_4h, round(usage_ma_24h, 7) AS usage_ma_24h,
      usage_diff, usage_pct_change,
      round(sum(usage_kwh) OVER (PARTITION BY CAST(time AS DATE) ORDER BY time ROWS UNBOUNDED PRECEDING), 6) AS cumulative_daily,
      round((usage_kwh - mean) / std, 6) AS z_score, abs((usage_kwh - mean) / std) > 3 AS z_anomaly,
      usage_kwh < lower OR usage_kwh > upper AS iqr_outlier,
      cost_tl, cost_if_night, cost_saving
    FROM w, e, m""")
twin("project_rename", "r", "c", "f", "s", "t", "a", "panel", f"""
    SELECT time AS "Zaman", {dec('usage_kwh')} AS "Tüketim (kWh)", {dec('z_score')} AS "Z-Score", load_type AS "Yük Tipi"
    FROM panel ORDER BY time DESC LIMIT 50""")
BOUNDS = {"usage_kwh": "157.18", "lagging_reactive_power": "80", "leading_reactive_power": "20", "co2_tco2": "0.08",
          "lagging_pf": "100", "leading_pf": "100"}
twin("clamp_range", "r", "SELECT time, " + ", ".join(
    f"CASE WHEN {c} < 0 THEN CAST(0 AS DOUBLE) WHEN {c} > {top} THEN CAST({top} AS DOUBLE) ELSE {c} END AS {c}"
    for c, top in BOUNDS.items()) + " FROM r")
twin("threshold_band", "r", "c", "f", "s", "t", "a", """
    SELECT time, usage_kwh,
      CASE WHEN usage_kwh >= 80 THEN 'red' ELSE 'green' END AS usage_band,
      CASE WHEN usage_kwh >= 90 THEN 'red' ELSE 'green' END AS series_band,
      CASE WHEN abs(z_score) >= 4 THEN 'red' ELSE '#EAB839' END AS z_band,
      CASE WHEN usage_kwh >= 200 THEN 'red' WHEN usage_kwh >= 50 THEN 'yellow' ELSE 'green' END AS total_band,
      CASE WHEN z_score >= 24 THEN 'green' WHEN z_score >= 1 THEN '#EAB839' WHEN z_score >= 0 THEN 'red' ELSE 'green' END AS hours_band
    FROM a""")

# --- filters
twin("flt_spike_or_drop", "r", "c", "f", "SELECT time, usage_kwh, z_score, load_type FROM f WHERE z_anomaly")
twin("flt_two_sided", "r", "m", "z", "SELECT time, usage_kwh, round(z_score, 6) AS z_score FROM z WHERE abs(z_score) > 3")
twin("flt_iqr", "r", "q", "e", "SELECT time, usage_kwh, load_type FROM r, e WHERE usage_kwh < lower OR usage_kwh > upper")
twin("flt_route_anomalies", "r", "c", "f", "s", "t", "a", "SELECT time, usage_kwh, z_score, load_type FROM a")
twin("flt_route_cost", "r", "c", "f", "s", "t", "k", "SELECT time, usage_kwh, tariff_type, cost_tl, load_type FROM k")
twin("flt_time_notnull", "r", "SELECT time, usage_kwh, load_type FROM r WHERE load_type <> 'Maximum_Load'")
twin("flt_dropna", "r", "c", "f", "w", "SELECT time, round(usage_ma_1h, 6) AS usage_ma_1h FROM w WHERE usage_ma_1h IS NOT NULL")
twin("flt_time_range", "r", """
    SELECT time, usage_kwh FROM r WHERE time >= TIMESTAMP '2024-01-16' AND time > (SELECT max(time) FROM r) - INTERVAL 6 HOUR""")
twin("flt_load_type_in", "r", "SELECT time, load_type FROM r WHERE load_type IN ('Light_Load', 'Maximum_Load')")

# --- joins
for name in ("join_left_anti", "join_insert_ignore"):
    twin(name, "r", "p", f"SELECT {RAW} FROM r WHERE time NOT IN (SELECT time FROM p)")
twin("join_scalar_stats", "r", "q", "m", """
    SELECT time, usage_kwh, round(mean, 6) AS mean, round(std, 6) AS std, round(q1, 6) AS q1, round(q3, 6) AS q3 FROM r, m, q""")
DAYS = "(VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) v(day_order, day_of_week)"
for name, kept in (("join_day_dimension", "WHERE day_of_week <> 'Sunday'"), ("agg_weekday_mean", "")):
    twin(name, "r", f"""
        SELECT day_order, v.day_of_week, round(mean_usage, 6) AS mean_usage FROM {DAYS}
        LEFT JOIN (SELECT day_of_week, avg(usage_kwh) AS mean_usage FROM r {kept} GROUP BY 1) g ON g.day_of_week = v.day_of_week""")
SPINE = "(SELECT CAST(unnest(generate_series((SELECT min(day) FROM {0}), (SELECT max(day) FROM {0}), INTERVAL 1 DAY)) AS DATE) AS day) v"
twin("join_date_spine", "r", f"SELECT v.day, round(g.total_usage, 4) AS total_usage FROM {SPINE.format('g')} LEFT JOIN g ON g.day = v.day",
     g="SELECT CAST(time AS DATE) AS day, sum(usage_kwh) AS total_usage FROM r WHERE week_status = 'Weekday' GROUP BY 1")
twin("join_table_lag", "r", "p", """
    SELECT last_raw, last_processed, round(CAST(epoch_us(last_raw) - epoch_us(last_processed) AS DOUBLE) / 1000000, 6) AS lag_seconds
    FROM (SELECT max(time) AS last_raw FROM r), (SELECT max(time) AS last_processed FROM p)""")

# --- aggregates
twin("agg_count", "r", "c", "f", "s", "t", "a", "panel", """
    SELECT (SELECT count(*) FROM r) AS total_rows, count(*) AS total_anomalies FROM panel WHERE load_type = 'Light_Load'""")
twin("agg_time_bounds", "r", "SELECT min(time) AS first_time, max(time) AS last_time FROM r")
twin("agg_count_by_load", "r", "c", "f", "s", "t", "a", "panel", "SELECT load_type, count(*) AS anomalies FROM panel GROUP BY 1")
twin("agg_share_by_load", "r", f"""
    SELECT load_type, count(*) AS rows, {dec('CAST(count(*) * 100 AS DOUBLE) / (SELECT count(*) FROM r)')} AS share_pct FROM r GROUP BY 1""")
NUMERIC = ("usage_kwh", "lagging_reactive_power", "leading_reactive_power", "co2_tco2", "lagging_pf", "leading_pf", "nsm")
twin("agg_describe", "r", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {dec(f'avg({c})')} AS mean, {dec(f'stddev_samp({c})')} AS std,
      {dec(f'min({c})')} AS min, {dec(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS q25,
      {dec(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS q50, {dec(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS q75,
      {dec(f'max({c})')} AS max FROM r""" for c in NUMERIC))
MOMENTS = "round(avg(usage_kwh), 6) AS mean, round(stddev_samp(usage_kwh), 6) AS std, min(usage_kwh) AS min, max(usage_kwh) AS max"
twin("agg_usage_stats", "r", f"SELECT {MOMENTS} FROM r")
HOURLY = "SELECT hour, avg(usage_kwh) AS mean_usage FROM c GROUP BY 1"
twin("agg_hourly_mean", "r", "c", "SELECT hour, round(mean_usage, 6) AS mean_usage FROM h", h=HOURLY)
twin("agg_peak_hour", "r", "c", """
    SELECT (SELECT hour FROM h ORDER BY mean_usage DESC, hour LIMIT 1) AS peak_hour, round(max(mean_usage), 6) AS peak_mean,
      (SELECT hour FROM h ORDER BY mean_usage, hour LIMIT 1) AS trough_hour, round(min(mean_usage), 6) AS trough_mean FROM h""", h=HOURLY)
twin("agg_week_status", "r", f"""
    SELECT week_status, {dec('avg(usage_kwh)')} AS mean, {dec('stddev_samp(usage_kwh)')} AS std, {dec('min(usage_kwh)')} AS min,
      {dec('max(usage_kwh)')} AS max FROM r GROUP BY 1""")
for key in ("shift", "month"):
    twin(f"agg_{key}_mean", "r", "c", f"SELECT {key}, round(avg(usage_kwh), 6) AS mean_usage FROM c GROUP BY 1")
twin("agg_tariff_cost", "r", "c", "f", "SELECT tariff_period, round(sum(cost_tl), 4) AS total_cost FROM f GROUP BY 1")
twin("agg_savings", "r", "c", "f", """
    SELECT round(sum(cost_tl), 4) AS total_cost, round(sum(cost_saving) FILTER (WHERE tariff_period = 'day'), 4) AS total_saving,
      round(sum(cost_saving) FILTER (WHERE tariff_period = 'day') * 100 / nullif(sum(cost_tl), 0), 4) AS saving_pct FROM f""")
twin("agg_daily_resample", "r", "d", f"SELECT v.day, round(d.mean_usage, 6) AS mean_usage FROM {SPINE.format('d')} LEFT JOIN d ON d.day = v.day")
twin("agg_hot_days", "r", "d", """
    SELECT day, round(mean_usage, 6) AS mean_usage, (SELECT count(*) FROM hot) AS hot_days FROM hot ORDER BY hot.mean_usage DESC, day LIMIT 10""",
     hot="SELECT * FROM d WHERE mean_usage > (SELECT avg(mean_usage) + 2 * stddev_samp(mean_usage) FROM d)")
twin("agg_hot_days_wide", "r", "d", """
    SELECT day, round(mean_usage, 6) AS mean_usage, (SELECT count(*) FROM hot) AS hot_days FROM hot""",
     hot="SELECT * FROM d WHERE mean_usage > (SELECT avg(mean_usage) + stddev_samp(mean_usage) FROM d)")
for name in ("agg_quantiles", "agg_quantiles_bounded"):
    twin(name, "r", "q", "e", "SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr FROM e")
OUTSIDE = "count(*) FILTER (WHERE usage_kwh < lower OR usage_kwh > upper)"
twin("agg_iqr_summary", "r", "q", "e", f"""
    SELECT {MOMENTS}, round(max(lower), 6) AS lower, round(max(upper), 6) AS upper, {OUTSIDE} AS outliers,
      round({OUTSIDE} * CAST(100 AS DOUBLE) / count(*), 6) AS outlier_pct FROM r, e""")


def bins(measure: str, n: int) -> str:
    return f"""
      SELECT '{measure}' AS measure, CAST(b AS INT) AS bin, round(mn + b * w, 6) AS bin_start, round(mn + (b + 1) * w, 6) AS bin_end,
        (SELECT count(*) FROM f WHERE least(floor(({measure} - mn) / w), {n - 1}) = b) AS rows
      FROM (SELECT min({measure}) AS mn, (max({measure}) - min({measure})) / {n} AS w FROM f), range({n}) g(b)"""


twin("agg_histogram", "r", "c", "f", f"{bins('usage_kwh', 50)} UNION ALL {bins('pf_efficiency', 30)}")
twin("agg_boxplot", "r", "q", """
    SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
      min(usage_kwh) FILTER (WHERE usage_kwh BETWEEN lo AND hi) AS whisker_low,
      max(usage_kwh) FILTER (WHERE usage_kwh BETWEEN lo AND hi) AS whisker_high,
      count(*) FILTER (WHERE usage_kwh NOT BETWEEN lo AND hi) AS fliers
    FROM r, (SELECT *, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi FROM q) GROUP BY q1, median, q3""")
twin("agg_anomaly_summary", "r", "q", "e", "m", "z", f"""
    SELECT count(*) AS rows, count(*) FILTER (WHERE abs(z_score) > 3) AS z_anomalies,
      round(count(*) FILTER (WHERE abs(z_score) > 3) * CAST(100 AS DOUBLE) / count(*), 6) AS z_rate_pct, {OUTSIDE} AS iqr_outliers FROM z, e""")
RATES = {"anomaly_pct": "z_anomaly", "low_pf_pct": "low_pf_flag", "night_pct": "tariff_period = 'night'", "day_pct": "tariff_period = 'day'"}
twin("agg_feature_rates", "r", "c", "f", "SELECT " + ", ".join(
    f"round(count(*) FILTER (WHERE {c}) * CAST(100 AS DOUBLE) / count(*), 6) AS {n}" for n, c in RATES.items()) + " FROM f")
twin("agg_mean_abs_z", "r", "c", "f", "s", "t", "a", "panel", f"SELECT {dec('avg(abs(z_score))')} AS mean_abs_z FROM panel")
twin("agg_max_usage", "r", "c", "f", "s", "t", "a", "panel", f"""
    SELECT {dec('max(usage_kwh)')} AS max_usage FROM panel WHERE load_type IN ('Light_Load', 'Medium_Load')""")
twin("agg_hours_since", "r", "c", "f", "s", "t", "a", f"""
    SELECT {dec('CAST(epoch_us((SELECT max(time) FROM r)) - epoch_us(max(detected_at)) AS DOUBLE) / 3600000000', 1)} AS hours_since FROM a""")
LAST_DAY = "SELECT * FROM f WHERE time > (SELECT max(time) FROM f) - INTERVAL 1 DAY"
twin("agg_filter_rate", "r", "c", "f", """
    SELECT round(count(*) FILTER (WHERE z_anomaly) * CAST(100 AS DOUBLE) / nullif(count(*), 0), 6) AS rate_pct FROM l""", l=LAST_DAY)
twin("agg_null_profile", "r", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL{" OR load_type = 'Maximum_Load'" if c == 'lagging_pf' else ''}) AS nulls FROM r"""
    for c in RAW.split(", ")))
twin("agg_distinct", "r", "c", "f", "s", "t", "k", """
    SELECT DISTINCT 'load_type' AS field, load_type AS value FROM r UNION ALL SELECT DISTINCT 'tariff_type', tariff_type FROM k""")
KINDS = {"time": "timestamp", "nsm": "int", "week_status": "string", "day_of_week": "string", "load_type": "string", "hour": "int",
         "day": "int", "month": "int", "quarter": "int", "is_weekend": "boolean", "shift": "string", "tariff_period": "string",
         "day_period": "string", "low_pf_flag": "boolean", "z_anomaly": "boolean"}
WIDE = RAW.split(", ") + [
    "hour", "day", "month", "quarter", "is_weekend", "shift", "tariff_period", "day_period", "pf_efficiency",
    "reactive_power_balance", "low_pf_flag", "z_score", "z_anomaly", "cost_tl", "cost_if_night", "cost_saving"]
twin("agg_shape", """
    SELECT CAST(position AS INT) AS position, "column", dtype, (SELECT count(*) FROM events) AS rows,
      CAST(27 AS INT) AS n_columns, CAST(16 AS INT) AS derived_columns FROM (VALUES """ + ", ".join(
    f"({i}, '{c}', '{KINDS.get(c, 'double')}')" for i, c in enumerate(WIDE, 1)) + ') v(position, "column", dtype)')
twin("agg_batch_metrics", "r", "c", "f", "s", "t", "a", "k", """
    SELECT CAST(0 AS BIGINT) AS batch_id, (SELECT count(*) FROM r) AS rows, (SELECT count(*) FROM a) AS anomalies,
      (SELECT count(*) FROM k) AS cost_rows, (SELECT count(*) FROM r) AS total""")

# --- windows
WINDOWS = {"win_ma_4": "usage_ma_1h", "win_ma_16": "usage_ma_4h", "win_ma_96": "usage_ma_24h", "win_diff": "usage_diff",
           "win_pct_change": "usage_pct_change"}
PLACES = {"usage_ma_1h": 6, "usage_ma_4h": 6, "usage_ma_24h": 7}
SHOWN = {c: f"round({c}, {PLACES[c]}) AS {c}" if c in PLACES else c for c in WINDOWS.values()}
for name, column in WINDOWS.items():
    twin(name, "r", "w", f"SELECT time, usage_kwh, {SHOWN[column]} FROM w", series="r")
for name in ("win_slot_halo", "win_indexed_halo"):
    twin(name, "r", "w", f"SELECT time, usage_kwh, {', '.join(SHOWN.values())} FROM w", series="r")
for name in ("win_cum_daily", "win_cum_daily_split"):
    twin(name, "r", """
    SELECT time, usage_kwh, round(sum(usage_kwh) OVER (PARTITION BY CAST(time AS DATE) ORDER BY time ROWS UNBOUNDED PRECEDING), 4)
      AS cumulative_daily FROM r""")
twin("win_pct_change_padded", "r", """
    SELECT time, (v - lag(v) OVER (ORDER BY time)) / nullif(lag(v) OVER (ORDER BY time), 0) * 100 AS usage_pct_change FROM padded""",
     padded="""SELECT time, last_value(CASE WHEN load_type <> 'Maximum_Load' THEN usage_kwh END IGNORE NULLS)
       OVER (ORDER BY time ROWS UNBOUNDED PRECEDING) AS v FROM r""")

# --- sort, limit, sets
twin("topk_latest_anomalies", "r", "c", "f", "s", "t", "a", "panel", f"""
    SELECT time, {dec('usage_kwh')} AS usage_kwh, {dec('z_score')} AS z_score, load_type FROM panel ORDER BY time DESC LIMIT 50""")
twin("sort_anomaly_series", "r", "c", "f", "s", "t", "a", "panel", f"""
    SELECT time, usage_kwh, {dec('z_score')} AS z_score FROM panel ORDER BY time""")
twin("sort_series", "r", "SELECT time, usage_kwh FROM r ORDER BY time")
twin("limit_head", "r", "m", "z", """
    SELECT time, usage_kwh, load_type, round(z_score, 6) AS z_score FROM z WHERE abs(z_score) > 3 ORDER BY time LIMIT 10""")
twin("set_enum_violations", "r", "c", "f", "s", "t", "k", """
    SELECT DISTINCT load_type AS violation FROM r WHERE load_type NOT IN ('Light_Load', 'Medium_Load')
    UNION ALL SELECT DISTINCT tariff_type FROM k WHERE tariff_type NOT IN ('night', 'day')""")

# --- data quality
GIVEN = {  # fixed values: table, columns looked for
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "orders": ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey", "n_usage_kwh"),
}
WRITTEN = {  # the library's tables, and one that lacks columns: rows, columns looked for
    "raw": (f"SELECT {RAW} FROM r", RAW.split(", ")),
    "processed": (f"SELECT {PROCESSED} FROM w WHERE usage_ma_1h IS NOT NULL", [c.split(" AS ")[-1].strip() for c in PROCESSED.split(",") if "(" not in c]),
    "anomalies": ("SELECT * FROM a", ["time", "usage_kwh", "z_score", "load_type", "detected_at"]),
    "costs": ("SELECT * FROM k", ["time", "usage_kwh", "tariff_type", "cost_tl", "load_type"]),
    "narrow": ("SELECT time, usage_kwh FROM r", ["time", "usage_kwh", "tariff_type", "cost_tl", "load_type"]),
}


def columns_found(table: str, source: str, names) -> str:
    return f"""SELECT 'exists:{table}' AS "check", CAST(count(*) AS DOUBLE) AS value, count(*) = {len(names)} AS passed
    FROM (SELECT DISTINCT column_name FROM {source} AND column_name IN ({", ".join(f"'{n}'" for n in names)}))"""


twin("dq_tables_exist", "r", "c", "f", "w", "s", "t", "a", "k", " UNION ALL ".join([
    *(columns_found(t, f"(DESCRIBE {rows}) WHERE true", names) for t, (rows, names) in WRITTEN.items()),
    """SELECT 'exists:missing', CAST(0 AS DOUBLE), false""",
    *(columns_found(t, f"information_schema.columns WHERE table_name = '{t}'", names) for t, names in GIVEN.items())]))
twin("dq_non_empty", "r", "c", "f", "s", "t", "a", "k", "p", " UNION ALL ".join(
    f"""SELECT 'non_empty:{name}' AS "check", CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed FROM {step}"""
    for name, step in (("energy_readings", "r"), ("processed_readings", "p"), ("anomalies", "a"), ("cost_analysis", "k"))))
LAST_HOUR = "SELECT * FROM r WHERE time > (SELECT max(time) FROM r) - INTERVAL 1 HOUR"


def check(name: str, value: str, passed: str, source: str) -> str:
    return f"""SELECT '{name}' AS "check", CAST({value} AS DOUBLE) AS value, {passed} AS passed FROM {source}"""


twin("dq_freshness", "r", check("fresh_rows", "count(*)", "count(*) > 0", "l"), l=LAST_HOUR)
twin("dq_usage_range", "r", check("usage_min", "min(usage_kwh)", "coalesce(min(usage_kwh) >= 0, true)", "l") + " UNION ALL "
     + check("usage_max", "max(usage_kwh)", "coalesce(max(usage_kwh) <= 200, true)", "l"), l=LAST_HOUR)
WRONG_LOADS = "(SELECT DISTINCT load_type FROM r WHERE load_type NOT IN ('Light_Load', 'Medium_Load', 'Maximum_Load'))"
twin("dq_load_type_enum", "r", check("load_type_enum", "count(*)", "count(*) = 0", WRONG_LOADS))
twin("dq_time_not_null", "r", check("time_not_null", "count(*)", "count(*) = 0", "(SELECT 1 FROM r WHERE time IS NULL)"))
DAY_RATE = "count(*) FILTER (WHERE z_anomaly) * CAST(100 AS DOUBLE) / nullif(count(*), 0)"
twin("dq_anomaly_rate", "r", "c", "f",
     check("anomaly_rate", f"round({DAY_RATE}, 6)", f"coalesce({DAY_RATE} BETWEEN 0 AND 10, true)", "l"), l=LAST_DAY)
twin("dq_tariff_enum", "r", "c", "f", "s", "t", "k", check(
    "tariff_enum", "count(*) FILTER (WHERE tariff_type NOT IN ('night', 'day'))",
    "count(*) > 0 AND count(*) FILTER (WHERE tariff_type NOT IN ('night', 'day')) = 0", "(SELECT DISTINCT tariff_type FROM k)"))
twin("dq_anomaly_z", "r", "c", "f", "s", "t", "a", check("anomaly_z", "count(*)", "count(*) = 0", "(SELECT 1 FROM a WHERE abs(z_score) <= 3)"))
LAG = "CAST(epoch_us((SELECT max(time) FROM r)) - epoch_us(max(time)) AS DOUBLE) / 1000000"
twin("dq_pipeline_lag", "r", "p", check("processing_lag", f"round({LAG}, 6)", f"{LAG} < 300", "p"))
twin("dq_message_fields", """SELECT 'message_fields' AS "check", CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed FROM events""")

ORACLE["scan_unprocessed_bucketed"] = ORACLE["scan_unprocessed"]
ORACLE["time_bounds_by_date"] = ORACLE["agg_time_bounds"]
twin("agg_quantiles_sketch", "SELECT p, count(value) > 0 AS within FROM events, (VALUES (0.05::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.95::DOUBLE)) v(p) GROUP BY p")
twin("decode_dead_letters", "r", "sorted_out", """
    SELECT 'good' AS reason, count(*) AS n, round(sum(usage_kwh), 4) AS usage_kwh FROM sorted_out WHERE reason IS NULL
    UNION ALL SELECT reason, count(*), NULL FROM sorted_out WHERE reason IS NOT NULL GROUP BY reason""")

# --- streams
twin("st_enrich", "r", "c", "f", "s", "t", "k", """
    SELECT time, usage_kwh, tariff_type, cost_tl, load_type, CAST(time AS DATE) AS date FROM k""")
twin("st_trigger", "r", "c", "f", "s", "t", "a", "SELECT time, usage_kwh, z_score, load_type FROM a")
twin("st_empty_guard", "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows FROM events")
twin("st_poll_features", "r", "first_delivery", "second_delivery", "taken", "c", "f", "w",
     f"SELECT {PROCESSED} FROM w WHERE usage_ma_1h IS NOT NULL")
ORACLE["st_poll_features"] = ORACLE["st_poll_features"].replace("FROM r)", "FROM taken)", 1)


def late_counts(order: str, lost: str) -> str:
    """Rows, late rows and anomalies per delivery: `order` numbers the rows of a series, whose first three are left out."""
    numbered = f"""SELECT time, row_number() OVER ({order}) AS n,
       (usage_kwh - CAST(27.39 AS DOUBLE)) / CAST(33.44 AS DOUBLE) > 3 OR usage_kwh < 2 AS flagged FROM {lost}"""
    taken = "count(*) FILTER (WHERE n > 3) AS rows"
    return f"""
    SELECT batch_id, rows, late, anomalies, CAST(sum(rows) OVER (ORDER BY batch_id) AS BIGINT) AS total FROM (
      SELECT CAST(0 AS BIGINT) AS batch_id, {taken}, CAST(0 AS BIGINT) AS late, count(*) FILTER (WHERE n > 3 AND flagged) AS anomalies
      FROM ({numbered}) WHERE time <= (SELECT max(time) FROM first_delivery)
      UNION ALL
      SELECT 1, {taken}, (SELECT count(*) FROM second_delivery WHERE time <= (SELECT max(time) FROM first_delivery)),
        count(*) FILTER (WHERE n > 3 AND flagged) FROM ({numbered}) WHERE time > (SELECT max(time) FROM first_delivery))"""


twin("st_late_single", "r", "first_delivery", "second_delivery", "taken", late_counts("ORDER BY time", "taken"))
twin("st_late_data", "r", "first_delivery", "second_delivery", "taken",
     late_counts("PARTITION BY lagging_reactive_power ORDER BY time", "taken"))
ORACLE["st_keyed_features"] = (
    ORACLE["st_poll_features"].replace("OVER (ORDER BY time", "OVER (PARTITION BY lagging_reactive_power ORDER BY time")
    .replace(f"SELECT {PROCESSED}", f"SELECT {PROCESSED}, CAST(lagging_reactive_power AS BIGINT) AS meter")
)
twin("st_compact", "r", "c", "f", "s", "t", "a", "SELECT time, usage_kwh, z_score, load_type FROM a")
twin("st_poll_publish", "r", "c", "f", "w", f"SELECT {PROCESSED} FROM w WHERE usage_ma_1h IS NOT NULL")
twin("st_dedup", "r", f"SELECT {RAW} FROM r")
twin("st_dedup_keyed", "r", f"SELECT {RAW} FROM r")
