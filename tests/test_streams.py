"""Streams equal batch runs, and running a batch again changes nothing."""

import pytest
from conftest import SF_DIR, column
from pyspark.sql import functions as F

from kilnwatt.checks import testbed as tb
from kilnwatt.operators.series import Layout
from kilnwatt.plans import features as ft
from kilnwatt.schemas import RAW_DDL
from kilnwatt.sources import topic
from kilnwatt.streaming import jobs
from kilnwatt.streaming.progress import finish


def rows(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=str)


PROCESSED = ("time", "usage_kwh", "usage_ma_1h", "usage_ma_4h", "usage_diff", "usage_pct_change", "z_anomaly", "cost_tl")


def feed(spark, path, parts):
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("layout", [Layout(), Layout(rows_per_task=60), Layout(rows_per_task=60, hot_factor=0, chunk_rows=64)])
def test_features_stream_equals_batch(spark, tmp_path, layout):
    """Six in-order deliveries of uneven size, one micro-batch each, against one batch run."""
    plain = tb.readings(spark, SF_DIR)
    days = [1, 2, 9, 10, 20, 28, 99]
    parts = [plain.where((F.dayofmonth("time") >= a) & (F.dayofmonth("time") < b)) for a, b in zip(days, days[1:])]
    folder = str(tmp_path)
    feed(spark, f"{folder}/in", parts)
    stream = spark.readStream.schema(RAW_DDL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    jobs.start_features(stream, folder, jobs.ONCE, layout).awaitTermination()
    got = jobs.read_processed(spark, folder)
    assert got.select("batch_id").distinct().count() == 6
    assert rows(got, *PROCESSED) == rows(ft.processed_readings(plain), *PROCESSED)


def test_tiny_batches_keep_the_frames(spark, raw, tmp_path):
    """Batches shorter than a frame lose nothing but the first three rows of the series."""
    folder = str(tmp_path)
    series = [(f"2024-01-01 {i:02d}:00:00", float(i * i)) for i in range(20)]
    feed(spark, f"{folder}/in", [raw(*series[i:i + 2]) for i in range(0, 20, 2)])
    stream = spark.readStream.schema(RAW_DDL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    jobs.start_features(stream, folder, jobs.ONCE).awaitTermination()
    assert rows(jobs.read_processed(spark, folder), *PROCESSED) == rows(ft.processed_readings(raw(*series)), *PROCESSED)


def test_late_rows_are_counted(spark, raw, tmp_path):
    folder = str(tmp_path)
    first = [(f"2024-01-01 0{i}:00:00", 1.0) for i in range(5)]
    feed(spark, f"{folder}/in", [raw(*first), raw(("2024-01-01 03:30:00", 7.0), ("2024-01-01 06:00:00", 5.0))])
    stream = spark.readStream.schema(RAW_DDL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    jobs.start_features(stream, folder, jobs.ONCE).awaitTermination()
    metrics = jobs.read_feature_counts(spark, folder).orderBy("batch_id").collect()
    assert [(r["rows"], r["late"], r["total"]) for r in metrics] == [(2, 0, 2), (1, 1, 3)]


def test_features_batch_replay(spark, raw, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], RAW_DDL).write.parquet(f"{folder}/tail/batch_id=-1")
    step = jobs.extend_features(folder)
    one, two = (raw(*[(f"2024-01-0{d} 0{i}:00:00", float(i)) for i in range(6)]) for d in (1, 2))
    step(one, 0)
    step(two, 1)
    before = rows(jobs.read_processed(spark, folder), *PROCESSED)
    step(two, 1)
    assert rows(jobs.read_processed(spark, folder), *PROCESSED) == before and len(before) == 9


def test_scoring_replay_leaves_sinks_unchanged(spark, tmp_path):
    folder = str(tmp_path)
    batch = tb.scored(spark, SF_DIR)
    process = jobs.fan_out(jobs.scores(folder))
    counts = []
    for _ in range(2):
        process(batch, 0)
        counts.append((jobs.read_anomalies(spark, folder).count(), jobs.read_costs(spark, folder).count()))
    assert counts[0] == counts[1] == (tb.anomalies(spark, SF_DIR).count(), tb.costs(spark, SF_DIR).count())
    assert jobs.read_anomalies(spark, folder).select("detected_at").distinct().count() == 1


def test_scoring_equals_batch_over_many_files(spark, tmp_path):
    folder = str(tmp_path)
    for part in tb.row_features(spark, SF_DIR).randomSplit([1.0] * 3, 5):
        topic.publish_files(topic.encode(part).coalesce(1), f"{folder}/topic")
    decoded = topic.decode(topic.read_message_files(spark, f"{folder}/topic", files_per_batch=1))
    finish(jobs.start_scoring(decoded, folder))
    names = ("time", "usage_kwh", "z_score", "load_type")
    assert rows(jobs.read_anomalies(spark, folder), *names) == rows(tb.anomalies(spark, SF_DIR), *names)
    metrics = jobs.read_metrics(spark, folder, jobs.SCORE_METRICS).orderBy("batch_id").collect()
    assert len(metrics) == 3 and metrics[-1]["total"] == tb.readings(spark, SF_DIR).count()


def test_replayed_readings_add_nothing(spark, raw, tmp_path):
    folder = str(tmp_path)
    part = raw(("2024-01-01 00:00:00", 1.0), ("2024-01-01 00:15:00", 2.0), ("2024-01-01 00:15:00", 2.0))
    feed(spark, f"{folder}/in", [part, part])
    stream = spark.readStream.schema(RAW_DDL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    jobs.start_unique(stream, folder).awaitTermination()
    assert sorted(column(spark.read.parquet(f"{folder}/readings"), "usage_kwh")) == [1.0, 2.0]


def test_preview_reaches_console(spark, raw, tmp_path):
    topic.publish_files(topic.encode(raw(("2024-01-01 00:00:00", 12.5))), str(tmp_path / "in"))
    preview = jobs.start_preview(topic.read_message_files(spark, str(tmp_path / "in")))
    preview.awaitTermination()
    done = preview.recentProgress[0]
    assert done["numInputRows"] == 1 and "Console" in done["sink"]["description"]


def test_running_totals_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(jobs, "BLOCK", 4)
    metrics = spark.range(11).selectExpr("id AS batch_id", "id + 1 AS rows")
    assert {r.batch_id: r.total for r in jobs.with_totals(metrics, "rows").collect()} == {b: (b + 1) * (b + 2) // 2 for b in range(11)}


def test_preview_counts_every_batch(spark, tmp_path):
    """More batches than a query's recent progress keeps."""
    source = str(tmp_path / "in")
    spark.range(0, 220, 1, 110).selectExpr("id", "'x' AS v").write.parquet(source)
    stream = spark.readStream.schema("id bigint, v string").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.start_preview(stream, sink="noop", counts=str(tmp_path / "counts")).awaitTermination()
    counted = spark.read.parquet(str(tmp_path / "counts"))
    assert counted.count() == 110 and counted.agg({"rows": "sum"}).first()[0] == 220
