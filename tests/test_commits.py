"""Batches show in all tables or in none; merging batches changes files, not rows."""

import glob
import os
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kilnwatt.checks import testbed as tb
from kilnwatt.schemas import RAW_DDL
from kilnwatt.session import settings
from kilnwatt.sources import topic
from kilnwatt.streaming import jobs
from kilnwatt.streaming.commits import Store, due, live
from kilnwatt.streaming.progress import finish
from conftest import SF_DIR


def rows(df, *names):
    return sorted(map(tuple, (df.select(*names) if names else df).collect()), key=str)


def test_interrupted_batch_shows_in_no_table(spark, tmp_path, monkeypatch):
    """The job stops after the first table of the second batch; the replay shows both batches once in both tables."""
    folder = str(tmp_path)
    first, second = tb.row_features(spark, SF_DIR).randomSplit([1.0, 1.0], 3)
    decoded = lambda: topic.decode(topic.read_message_files(spark, f"{folder}/topic"))
    topic.publish_files(topic.encode(first), f"{folder}/topic")
    finish(jobs.start_scoring(decoded(), folder))
    before = rows(jobs.read_anomalies(spark, folder)), rows(jobs.read_costs(spark, folder))

    write = Store.write

    def stops(self, table, frame, batch_id):
        if table == "cost_analysis":
            raise OSError("no space left")
        write(self, table, frame, batch_id)

    monkeypatch.setattr(Store, "write", stops)
    topic.publish_files(topic.encode(second), f"{folder}/topic")
    with pytest.raises(StreamingQueryException):
        finish(jobs.start_scoring(decoded(), folder))
    assert glob.glob(f"{folder}/anomalies/batch_id=1/date=*")  # written, but not committed
    assert (rows(jobs.read_anomalies(spark, folder)), rows(jobs.read_costs(spark, folder))) == before

    monkeypatch.setattr(Store, "write", write)
    finish(jobs.start_scoring(decoded(), folder))
    names = ("time", "usage_kwh", "z_score", "load_type")
    assert rows(jobs.read_anomalies(spark, folder), *names) == rows(tb.anomalies(spark, SF_DIR), *names)
    costs = ("time", "usage_kwh", "tariff_type", "cost_tl", "load_type")
    assert rows(jobs.read_costs(spark, folder), *costs) == rows(tb.costs(spark, SF_DIR), *costs)


def test_metrics_come_from_the_progress(spark, tmp_path, monkeypatch):
    """Rows, anomalies and cost rows of each batch and in total, without an aggregation over the batch."""
    folder = str(tmp_path)
    for part in tb.row_features(spark, SF_DIR).randomSplit([1.0] * 3, 5):
        topic.publish_files(topic.encode(part).coalesce(1), f"{folder}/topic")
    process = jobs.fan_out(jobs.scores(folder))
    assert "agg" not in process.__code__.co_names
    decoded = topic.decode(topic.read_message_files(spark, f"{folder}/topic", files_per_batch=1))
    finish(jobs.start_scoring(decoded, folder))
    metrics = jobs.read_metrics(spark, folder, jobs.SCORE_METRICS).orderBy("batch_id").collect()
    written = {n: {r.batch_id: r["count"] for r in df.groupBy("batch_id").count().collect()} for n, df in (("a", jobs.read_anomalies(spark, folder)), ("c", jobs.read_costs(spark, folder)))}
    assert {r.batch_id: r.anomalies for r in metrics if r.anomalies} == written["a"]
    assert {r.batch_id: r.cost_rows for r in metrics if r.cost_rows} == written["c"]
    assert metrics[-1].total == sum(r.rows for r in metrics) == tb.readings(spark, SF_DIR).count()


LAYOUT = "time timestamp, usage_kwh double"


def batches(spark, store, ids):
    for i in ids:
        part = spark.range(4).selectExpr(f"timestamp_seconds(id * 86400 + {i}) AS time", f"CAST({i} AS DOUBLE) AS usage_kwh")
        store.write("readings", part.coalesce(1), i)
        store.write("notes", spark.sql(f"SELECT {i}L AS n"), i)
        store.commit(spark, i)


def test_two_hundred_batches_become_few_files(spark, tmp_path):
    """The same rows before, while and after 200 batches are merged; a reader that began before ends unharmed; dates prune."""
    store = Store(str(tmp_path), {"readings": LAYOUT, "notes": "n bigint"}, fan=14)
    store.create(spark)
    # Written at once, as 200 runs of the job would have left them.
    days = spark.range(200).selectExpr("id AS batch_id", "explode(sequence(0, 3)) AS day").coalesce(1)
    table = days.selectExpr("timestamp_seconds(day * 86400 + batch_id) AS time", "CAST(batch_id AS DOUBLE) AS usage_kwh", "batch_id")
    table.withColumn("date", F.to_date("time")).write.partitionBy("batch_id", "date").parquet(f"{tmp_path}/readings")
    spark.range(200).coalesce(1).selectExpr("id AS n", "id AS batch_id").write.partitionBy("batch_id").parquet(f"{tmp_path}/notes")
    spark.range(200).coalesce(1).selectExpr("id AS first", "id AS last", "0D AS written_at", "concat(id, '-', id) AS run").write.mode("append").partitionBy("run").parquet(f"{tmp_path}/commits")
    expected, notes = rows(store.read(spark, "readings")), rows(store.read(spark, "notes"))
    assert len(expected) == 800 and len(notes) == 200
    early_reader = store.read(spark, "readings")

    seen, stop = [], threading.Event()

    def reader():
        while not stop.is_set():
            seen.append(store.read(spark, "readings").count())
            stop.wait(2)

    thread = threading.Thread(target=reader)
    thread.start()
    merged = store.compact(spark)
    stop.set()
    thread.join()
    assert set(seen) == {800}
    assert store.runs(spark) == [(0, 195), *[(i, i) for i in range(196, 200)]] and len(merged) == 15
    assert rows(early_reader) == expected
    assert rows(store.read(spark, "readings")) == expected and rows(store.read(spark, "notes")) == notes
    assert store.clean(spark) == 0  # running readers may still need them
    assert store.clean(spark, keep=0) == 196 + 14
    files = glob.glob(f"{tmp_path}/readings*/**/*.parquet", recursive=True)
    assert len(files) <= 5 * 4 and rows(store.read(spark, "readings")) == expected

    one_day = store.read(spark, "readings").where("date = DATE'1970-01-02'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and one_day.count() == 200
    batches(spark, store, [200, 201])  # the store goes on
    assert store.read(spark, "readings").count() == 808 and not store.compact(spark)


def test_merge_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    store = Store(str(tmp_path), {"readings": LAYOUT, "notes": "n bigint"}, fan=3)
    store.create(spark)
    assert store.read(spark, "readings").collect() == [] and store.compact(spark) == []
    batches(spark, store, [0, 1, 5])  # batches without rows may be missing
    expected = rows(store.read(spark, "readings"))
    commit = Store.commit
    monkeypatch.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        store.compact(spark)
    assert store.runs(spark) == [(0, 0), (1, 1), (5, 5)] and rows(store.read(spark, "readings")) == expected
    monkeypatch.setattr(Store, "commit", commit)
    assert store.compact(spark) == [(0, 5)] and rows(store.read(spark, "readings")) == expected
    assert store.committed(spark, 1) and not store.committed(spark, 6)


def test_runs():
    assert live([(0, 0), (1, 1), (0, 1), (2, 2), (0, 1)]) == [(0, 1), (2, 2)]
    assert due([(0, 9), (10, 10), (11, 11)], 2) == [(10, 10), (11, 11)]
    assert due([(0, 9), (10, 10)], 2) == []


def meters(spark, spec):
    return spark.createDataFrame([(t, float(u), m) for t, u, m in spec], "time string, usage_kwh double, meter string").selectExpr(
        "CAST(time AS timestamp) AS time", "usage_kwh", "5D AS lagging_reactive_power", "1D AS leading_reactive_power", "0D AS co2_tco2",
        "90D AS lagging_pf", "90D AS leading_pf", "0 AS nsm", "'Weekday' AS week_status", "'Monday' AS day_of_week", "'Light_Load' AS load_type", "meter",
    )


def test_keyed_frames_continue_after_restart(spark, tmp_path):
    """Deliveries of uneven size, a restart between each two: the rows of one batch run per series."""
    from kilnwatt.plans.features import processed_readings

    folder = str(tmp_path)
    spec = [(f"2024-01-0{1 + i // 24} {i % 24:02d}:00:00", (i * 7) % 13, "ab"[i % 2]) for i in range(60)]
    spec += [(f"2024-01-0{1 + i // 24} {i % 24:02d}:30:00", i, None) for i in range(5)] + [(None, 1.0, "a")]
    cuts = [0, 3, 4, 40, 65, 66]
    for a, b in zip(cuts, cuts[1:]):
        part = meters(spark, spec[a:b])
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        finish(jobs.start_keyed_features(spark.readStream.schema(part.schema).parquet(f"{folder}/in"), folder, "meter"))
    got = jobs.read_keyed(spark, folder, "meter")
    names = ("time", "usage_kwh", "usage_ma_1h", "usage_ma_4h", "usage_diff", "usage_pct_change", "z_anomaly", "cost_tl")
    for meter in "ab":
        want = processed_readings(meters(spark, [s for s in spec if s[2] == meter and s[0]]).drop("meter")).select(*names)
        rounding = [F.round(n, 9).alias(n) if n.startswith("usage_") else n for n in names]
        assert rows(got.where(F.col("meter") == meter).select(*rounding)) == rows(want.select(*rounding))


def test_late_rows_by_watermark_and_by_series(spark, tmp_path):
    folder = str(tmp_path)
    first = [(f"2024-01-01 {i:02d}:00:00", i, "a") for i in range(6)] + [(f"2024-01-01 {i:02d}:00:00", i, "b") for i in range(4)]
    second = [("2024-01-01 04:30:00", 1, "a"), ("2024-01-01 04:45:00", 1, "b"), ("2024-01-01 03:00:00", 1, "b"), ("2024-01-01 07:00:00", 1, "a")]
    for part in (first, second):
        df = meters(spark, part)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        finish(jobs.start_keyed_features(spark.readStream.schema(df.schema).parquet(f"{folder}/in"), folder, "meter", "1 hour"))
    metrics = [(r.rows, r.late, r.total) for r in jobs.read_metrics(spark, folder, jobs.FEATURE_METRICS).orderBy("batch_id").collect()]
    # 03:00 is behind the watermark of 04:00, 04:30 behind its own series only.
    assert metrics == [(4, 0, 4), (2, 2, 6)]


def test_unique_state_is_bounded_by_the_watermark(spark, raw, tmp_path):
    """A replay adds nothing; the state only holds the batch's keys and those of the two hours before, nine."""
    folder = str(tmp_path)
    series = [(f"2024-01-{1 + i // 96:02d} {i // 4 % 24:02d}:{i % 4 * 15:02d}:00", float(i)) for i in range(400)]
    parts = [series[i : i + 100] for i in range(0, 400, 100)]
    for n, part in enumerate([*parts, parts[-1], parts[0], [*parts[3][-2:], *parts[3][-2:], ("2024-01-05 04:00:00", 7.0), ("2024-01-05 04:00:00", 7.0)]]):
        raw(*part).coalesce(1).write.mode("append").parquet(f"{folder}/in/n={n}")
        stream = spark.readStream.schema(RAW_DDL).parquet(f"{folder}/in/n=*")
        finish(jobs.start_unique_recent(stream, folder))
    got = sorted(r[0] for r in jobs.read_unique(spark, folder).select("usage_kwh").collect())
    assert got == sorted([*(float(i) for i in range(400)), 7.0])
    metrics = jobs.read_metrics(spark, folder, jobs.UNIQUE_METRICS).orderBy("batch_id").collect()
    assert max(r.state_rows for r in metrics) <= 100 + 9 and metrics[-1].state_rows <= 10
    assert sum(r.late for r in metrics) >= 190 and metrics[-1].total == 401
    assert os.path.isdir(f"{folder}/commits")


def test_tables_without_time_are_written_by_several_tasks(spark, tmp_path):
    """Many dead letters of one batch aren't one task's; few of them are one file."""
    store = Store(str(tmp_path), {"dead_letters": "value string, reason string"})
    store.create(spark)
    letters = spark.range(0, 20_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("value"), F.lit("unreadable").alias("reason"))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}):
        for batch_id, rows in enumerate((letters, letters.limit(50), letters.limit(0))):
            store.write("dead_letters", rows, batch_id)
            store.commit(spark, batch_id)
    kept = store.read(spark, "dead_letters")
    assert {r.batch_id: r["count"] for r in kept.groupBy("batch_id").count().collect()} == {0: 20_000, 1: 50}
    files = [sum(f"/batch_id={b}/" in f for f in kept.inputFiles()) for b in range(3)]
    assert files[0] >= 4 and files[1] == 1 and files[2] <= 1
    assert kept.where("batch_id = 0").select("value", "reason").exceptAll(letters).isEmpty()
