"""Joins, cursors, sources, sinks and checks."""

import logging

import pytest
from conftest import column
from pyspark.sql import functions as F

from kilnwatt.checks import queries as q
from kilnwatt.functions.measures import nan_to_null
from kilnwatt.operators import filters as flt
from kilnwatt.operators import joins, quality
from kilnwatt.plans import features as ft
from kilnwatt.schemas import PROCESSED_DDL, RAW_COLUMNS, RAW_DDL, RAW_MESSAGE_DDL
from kilnwatt.sources import csv, tables, topic

T = ["2024-01-01 00:00:00", "2024-01-01 00:15:00", "2024-01-01 00:30:00"]


def texts(df):
    return sorted(str(t) for t in column(df, "time"))


def test_unprocessed_and_late(raw):
    all_rows, done = raw(*[(t, 1.0) for t in T]), raw((T[1], 1.0))
    assert texts(joins.unprocessed(all_rows, done, "2023-01-01")) == [T[0], T[2]]
    assert texts(joins.unprocessed(all_rows, done, T[0])) == [T[2]]
    assert texts(joins.unprocessed(all_rows, done, "2023-01-01", limit=1)) == [T[0]]


def test_cursor_default(raw):
    assert str(joins.resume_cursor(raw((T[1], 1.0))).first()[0]) == T[1]
    assert str(joins.resume_cursor(raw((T[1], 1.0)).limit(0)).first()[0]) == "2000-01-01 00:00:00"


def test_keyset_inside_ties(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' AS time, id FROM range(5)")
    assert joins.next_page(df, "2024-01-01", 2).count() == 0
    page = joins.next_page(df, "2024-01-01", 2, tiebreak="id", after=1)
    assert column(page, "id") == [2, 3]


def test_pages_without_tiebreak_lose_nothing(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, (id div 7) * 60) AS time, id FROM range(30)").cache()
    cursor, mark, seen = "2023-12-31", None, []
    while page := joins.next_page(df.withColumn("mark", joins.row_mark(df)), cursor, 4, tiebreak="mark", after=mark).collect():
        seen += [r.id for r in page]
        cursor, mark = str(page[-1].time), page[-1].mark
    assert sorted(seen) == list(range(30))
    first = joins.next_page(df, "2023-12-31", 4).collect()
    after = df.where(F.col("id") == first[-1].id).select(joins.row_mark(df)).first()[0]
    rest = joins.next_page(df, str(first[-1].time), 100, after=after).collect()
    assert sorted(r.id for r in [*first, *rest]) == list(range(30))


def test_replays_with_null_times_add_nothing(spark, raw, tmp_path):
    path = str(tmp_path / "keyed")
    tables.create_table(spark, path, f"{RAW_DDL}, date date")
    batch = raw((None, 1.0), (None, 2.0), (None, 2.0), (T[0], 3.0))
    assert [tables.append_new(batch, path, RAW_DDL) for _ in range(3)] == [1, 0, 0]
    assert tables.read_by_date(spark, path, RAW_DDL).count() == 1


def test_append_reads_only_the_dates_at_hand(spark, raw, tmp_path):
    path = str(tmp_path / "days")
    tables.write_by_date(raw(*[(f"2024-01-0{d} 12:00:00", float(d)) for d in range(1, 9)]), path)
    assert tables.append_new(raw(("2024-01-01 12:00:00", 1.0), ("2024-01-08 13:00:00", 1.0)), path, RAW_DDL) == 1


def test_hot_key_is_split_in_the_anti_join(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("-1", "-1", "20k", "10k"), strict=True):
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 5 < 3, 7).otherwise(F.col("id")).alias("time"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        out = joins.not_in(rows, spark.range(0, 30_000, 1, 4).select((F.col("id") * 2).alias("time")))
        assert out.count()
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_publish_cursor(spark):
    assert str(spark.range(1).select(joins.publish_cursor("2024-01-01 10:00:00").alias("c")).first()["c"]) == "2024-01-01 09:00:00"


def test_insert_ignore_is_deterministic(raw):
    target, new = raw((T[0], 1.0)), raw((T[0], 9.0), (T[1], 5.0), (T[1], 3.0))
    added = joins.insert_ignore(new, target).collect()
    assert [(str(r.time), r.usage_kwh) for r in added] == [(T[1], 3.0)]


def test_anti_join_plan(raw):
    plan = joins.not_in(raw((T[0], 1.0)), raw((T[1], 1.0)))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_dates_are_pruned(spark, raw, tmp_path):
    path = str(tmp_path / "dated")
    assert tables.write_by_date(raw(*[(f"2024-01-0{d} 12:00:00", float(d)) for d in range(1, 6)]), path) == 5
    picked = flt.in_time_range(tables.read_by_date(spark, path, RAW_DDL), "2024-01-02", "2024-01-03 23:00:00")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(time)" in plan
    assert sorted(column(picked, "usage_kwh")) == [2.0, 3.0]


def test_append_new_twice(spark, raw, tmp_path):
    path = str(tmp_path / "keyed")
    tables.create_table(spark, path, f"{RAW_DDL}, date date")
    rows = raw((T[0], 1.0), (T[1], 2.0), (T[1], 2.0))
    assert tables.append_new(rows, path, RAW_DDL) == 2
    assert tables.append_new(rows, path, RAW_DDL) == 0
    assert tables.read_by_date(spark, path, RAW_DDL).count() == 2


def test_processed_write_counts(spark, raw, tmp_path):
    rows = ft.processed_readings(raw(*[(f"2024-01-01 00:0{i}:00", float(i)) for i in range(6)]))
    assert tables.write_processed(rows, str(tmp_path / "p")) == 3
    assert tables.read_by_date(spark, str(tmp_path / "p"), PROCESSED_DDL).columns[:-1] == rows.columns


def test_csv_with_missing_column(spark, tmp_path, caplog):
    (tmp_path / "in.csv").write_text(
        "date,Usage_kWh,Lagging_Current_Reactive.Power_kVarh,CO2(tCO2),WeekStatus,Load_Type\n"
        "13/01/2018 00:15,3.17,2.95,0.0,Saturday,Light_Load\nx,abc,1,0,Weekday,Light_Load\n"
    )
    with caplog.at_level(logging.WARNING):
        df = csv.load_csv(spark, str(tmp_path / "in.csv"))
    rows = df.collect()
    assert df.columns == RAW_COLUMNS and "nsm" in caplog.text
    assert str(rows[0].time) == "2018-01-13 00:15:00" and rows[0].lagging_reactive_power == 2.95 and rows[0].nsm is None
    assert rows[1].time is None and rows[1].usage_kwh is None


def test_messages_round_trip(raw):
    df = raw({"time": T[1], "usage_kwh": 3.25, "load_type": "Light_Load", "nsm": 900}, (T[2], None))
    sent = topic.encode(df)
    assert sorted(column(sent, "key")) == [f"{T[1]}+00:00", f"{T[2]}+00:00"]
    assert sorted(map(tuple, topic.decode(sent, RAW_MESSAGE_DDL).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_bad_messages(spark):
    bodies = ["{bad", None, '{"time":"garbage","usage_kwh":1}', '{"time":"2024-01-01T00:00:00Z","usage_kwh":NaN}']
    df = topic.decode(spark.createDataFrame([(b,) for b in bodies], "value string"), RAW_MESSAGE_DDL)
    rows = ft.add_fixed_z(df).collect()
    assert len(rows) == 1 and rows[0].usage_kwh is None and rows[0].z_anomaly is False


def test_nan_becomes_null(spark):
    odd = nan_to_null(spark.sql("SELECT double('NaN') AS v, double('Infinity') AS w, float('-Infinity') AS x, 1 AS n")).first()
    assert (odd["v"], odd["w"], odd["x"], odd["n"]) == (None, None, None, 1)


def test_checks(spark, raw):
    rows = [{"time": t, "usage_kwh": u, "load_type": lt} for t, u, lt in zip(T, (-1.0, 5.0, 250.0), ("Light_Load", "Odd", None))]
    df = raw(*rows)
    assert [(r.check, r.value, r.passed) for r in quality.usage_in_range(df, T[2]).collect()] == [("usage_min", -1.0, False), ("usage_max", 250.0, False)]
    assert quality.load_types_valid(df).first()["value"] == 1.0 + 1.0  # the odd value and null
    assert quality.fresh_rows(df, T[2], "20 minutes").first()["value"] == 2.0
    assert quality.fresh_rows(df, "2025-01-01").first()["passed"] is False
    assert quality.time_not_null(df).first()["passed"] is True
    assert quality.processing_lag_ok(df, raw((T[0], 1.0))).first()["passed"] is False
    assert quality.processing_lag_ok(df, df.limit(0)).first()["passed"] is True


def test_missing_table_is_reported(spark, raw, tmp_path):
    tables.write_by_date(raw((T[0], 1.0)), str(tmp_path / "raw"))
    found = quality.tables_exist(spark, {"raw": (str(tmp_path / "raw"), RAW_DDL), "gone": (str(tmp_path / "gone"), RAW_DDL)})
    assert {r.check: r.passed for r in found.collect()} == {"exists:raw": True, "exists:gone": False}


def test_message_check_skips_old_format(spark, raw):
    old = topic.encode(raw((T[0], 1.0)))
    current = topic.encode(ft.add_fixed_z(ft.add_calendar(raw((T[0], 1.0)))))
    assert quality.message_fields(old).first()["passed"] is False
    assert quality.message_fields(old.unionAll(current)).first()["passed"] is True
    short = current.withColumn("value", F.regexp_replace("value", '"shift"', '"shifted"'))
    assert quality.message_fields(short.unionAll(current)).first()["passed"] is False


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_polls_prune_dates(spark, raw, tmp_path):
    """Both sides of the poll and the pages read the dates from the cursor on; the cursor reads the newest date."""
    days = [f"2024-01-{d:02d} 06:00:00" for d in range(1, 21)]
    for name, rows in (("raw", [(t, 1.0) for t in days]), ("done", [(t, 1.0) for t in days[:12]])):
        tables.write_by_date(raw(*rows), str(tmp_path / name))
    read = lambda name: tables.read_by_date(spark, str(tmp_path / name), RAW_DDL)
    poll = joins.unprocessed(read("raw"), read("done"), days[9])
    assert plan_of(poll).count("(date#") >= 2 and plan_of(poll).count(">= 2024-01-10") >= 2
    assert texts(poll) == days[12:]
    page = joins.next_page(read("raw"), days[15], 2)
    assert ">= 2024-01-16" in plan_of(page) and texts(page) == days[16:18]
    cursor = tables.newest_time(spark, str(tmp_path / "done"), RAW_DDL)
    assert "= 2024-01-12" in plan_of(cursor) and str(cursor.first()[0]) == days[11]
    ends = tables.time_ends(spark, str(tmp_path / "raw"), RAW_DDL)
    assert [str(x) for x in ends.first()] == [days[0], days[-1]]


def test_ends_of_odd_tables(spark, raw, tmp_path):
    """Null times and an empty table: the default, and nulls."""
    empty, nulls = str(tmp_path / "empty"), str(tmp_path / "nulls")
    tables.create_table(spark, empty, f"{RAW_DDL}, date date")
    tables.write_by_date(raw((None, 1.0), (T[1], 2.0)), nulls)
    assert str(tables.newest_time(spark, empty, RAW_DDL).first()[0]) == joins.EPOCH_CURSOR
    assert tuple(tables.time_ends(spark, empty, RAW_DDL).first()) == (None, None)
    assert str(tables.newest_time(spark, nulls, RAW_DDL).first()[0]) == T[1]


def test_bucketed_poll_has_no_exchange(spark, raw, tmp_path):
    rows = [(f"2024-01-01 00:{i % 60:02d}:{i // 60:02d}", float(i)) for i in range(300)] + [(T[0], 5.0)] * 150  # a hot time
    for name, part in (("raw_b", rows), ("done_b", rows[100:200])):
        tables.write_bucketed(raw(*part), name, str(tmp_path / name), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = joins.not_in(spark.table("raw_b"), spark.table("done_b"))
        assert "Exchange" not in plan_of(fresh) and "SortMergeJoin" in plan_of(fresh)
        taken = {t for t, _ in rows[100:200]}
        assert fresh.count() == sum(t not in taken for t, _ in rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("raw_b", "done_b"):
            spark.sql(f"DROP TABLE {name}")


def test_every_message_is_kept(spark, tmp_path):
    good = '{"time":"2024-01-01T00:00:00","usage_kwh":1.5}'
    cases = [(good, None), (None, "unreadable"), ("", "unreadable"), ("{broken", "unreadable"), ("[1]", "unreadable"), ("7", "unreadable"), ("{}", "time missing"),
             ('{"time":"soon","usage_kwh":1}', "time unreadable"), ('{"time":"2024-01-01T00:00:00"}', "field missing"), (good, None)]
    df = spark.createDataFrame([("k", v) for v, _ in cases], "key string, value string")
    got = topic.decode_all(df, "time string, usage_kwh double", ("usage_kwh",)).collect()
    assert sorted(((r.value, r.reason) for r in got), key=str) == sorted(cases, key=str)


def test_sketched_quantiles(spark):
    """Ranks stay within the bound, also where a third of the rows is equal; the merge of parts is as good as one."""
    from kilnwatt.operators import quantiles

    df = spark.range(60_000).selectExpr("id % 7 AS part", "CASE WHEN id % 3 = 0 THEN 5D ELSE CAST(hash(id) % 100000 AS DOUBLE) END AS v")
    df = df.unionByName(spark.sql("SELECT 1L AS part, explode(array(NULL, double('NaN'), double('Infinity'))) AS v"))
    values = sorted(r.v for r in df.where("v IS NOT NULL AND v < double('Infinity')").collect())
    for r in quantiles.sketched_quantiles(quantiles.quantile_sketches(df, "v", "part"), [0.0, 0.1, 0.4, 0.9, 1.0]).collect():
        below, up_to = sum(x < r.quantile for x in values) / len(values), sum(x <= r.quantile for x in values) / len(values)
        assert below - 0.01 <= r.p <= up_to + 0.01
    assert quantiles.sketched_quantiles(quantiles.quantile_sketches(df.limit(0), "v", "part"), [0.5]).first().quantile is None


def test_tables_exist_odd(spark, tmp_path):
    """Empty tables are there; a narrow one lacks columns; a missing one is the finding."""
    tables.create_table(spark, str(tmp_path / "raw"), RAW_DDL, by=())
    tables.create_table(spark, str(tmp_path / "narrow"), "time timestamp, usage_kwh double", by=())
    found = quality.tables_exist(spark, {n: (str(tmp_path / n), RAW_DDL) for n in ("raw", "narrow", "missing")})
    assert [(r.check, r.value, r.passed) for r in found.collect()] == [("exists:raw", 11.0, True), ("exists:narrow", 2.0, False), ("exists:missing", 0.0, False)]


@pytest.mark.parametrize("values, want", [([50.0] * 4 + [150.0], {"raw": 5, "processed": 2, "anomalies": 1, "costs": 5, "narrow": 5}), ([], dict.fromkeys(("raw", "processed", "anomalies", "costs", "narrow"), 0))])
def test_table_check_writes_the_four_tables(spark, tmp_path, monkeypatch, values, want):
    """The tables looked up hold the rows of the test data; those without rows are tables too."""
    events = spark.createDataFrame([(i, f"2024-01-01 0{i}:00:00", i, "view", v, '{"k": 1}') for i, v in enumerate(values)], q.GIVEN["events"].replace("ts timestamp", "ts string"))
    events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(q, "fresh_path", lambda spark, label: str(tmp_path / label))
    found = {r.check: (r.value, r.passed) for r in q.dq_tables_exist(spark, str(tmp_path)).collect()}
    four = {"raw": 11.0, "processed": 30.0, "anomalies": 5.0, "costs": 5.0}
    assert {n: found[f"exists:{n}"] for n in four} == {n: (columns, True) for n, columns in four.items()}
    assert [found[f"exists:{n}"] for n in ("narrow", "missing", "events", "orders")] == [(2.0, False), (0.0, False), (6.0, True), (0.0, False)]
    assert {n: spark.read.parquet(str(tmp_path / "store" / n)).count() for n in want} == want
