"""Windows over the whole series: every way of cutting it equals the plain window."""

import random
from dataclasses import replace

import pytest
from conftest import column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilnwatt.operators import series as sr
from kilnwatt.plans import features as ft

PLAIN = sr.Layout()


def numbers(spark, n, seed=1, crowd=0.0, nulls=0.0, sparse=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = 1_700_000_000 + (i * 900 if not sparse else i * 60 + (i // 40) * 1_000_000)
        if rng.random() < crowd:
            at = 1_700_000_000 + n * 400
        rows.append((at, i, None if rng.random() < nulls else round(rng.uniform(0, 150), 2)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "at bigint, id bigint, usage_kwh double")
    return df.select(F.timestamp_seconds("at").alias("time"), "id", "usage_kwh")


def rolled(df, layout, day_frame=True, **more):
    out = ft.add_rolling(df, tiebreak=["id"], day_frame=day_frame, layout=layout, **more)
    return sorted(tuple(r) for r in out.select("id", "usage_ma_1h", "usage_ma_4h", "usage_ma_24h", "usage_diff", "usage_pct_change").collect())


@pytest.mark.parametrize("crowd, nulls, sparse", [(0.0, 0.0, False), (0.35, 0.05, False), (0.0, 0.1, True)])
@pytest.mark.parametrize(
    "layout",
    [
        sr.Layout(rows_per_task=100, chunk_rows=128),
        sr.Layout(rows_per_task=100, chunk_rows=95, hot_factor=0),
        sr.Layout(rows_per_task=37, chunk_rows=200, hot_factor=0),
        sr.Layout(rows_per_task=5, hot_factor=10_000),
        sr.Layout(rows_per_task=300, hot_factor=10_000),
    ],
)
def test_cut_equals_plain(spark, layout, crowd, nulls, sparse):
    df = numbers(spark, 700, crowd=crowd, nulls=nulls, sparse=sparse)
    assert rolled(df, layout) == rolled(df, PLAIN)


def test_crowded_time_goes_by_position(spark):
    layout = sr.Layout(rows_per_task=50)
    crowded, even = numbers(spark, 900, crowd=0.4), numbers(spark, 900)
    for df, hot in ((crowded, True), (even, False)):
        slots = sr.count_slots(df, "time", 15, layout)
        assert sum(slots.counts.values()) == 900
        assert layout.too_hot(max(slots.counts.values()), 900) is hot


def tied(spark, files):
    """40 % of 2,000 readings share one time; the same rows in two file orders."""
    rng = random.Random(9)
    rows = [(1_700_000_000 + (1000 if rng.random() < 0.4 else i) * 900, round(rng.uniform(0, 150), 1), rng.choice("abc")) for i in range(2000)]
    random.Random(files).shuffle(rows)
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 5), "at bigint, usage_kwh double, load_type string")
    return df.select(F.timestamp_seconds("at").alias("time"), "usage_kwh", "load_type")


def test_ties_do_not_depend_on_cut_or_file_order(spark):
    """Without a tie-breaker, slots, positions and the plain window give the same rows, in either file order."""
    layouts = [sr.Layout(rows_per_task=100, hot_factor=10_000), sr.Layout(rows_per_task=100, hot_factor=0), PLAIN]
    found = []
    for files in (1, 2):
        df = tied(spark, files)
        order = sr.series_order(df, "time", (), ["usage_kwh"])
        plain = df.withColumns({"usage_diff": F.col("usage_kwh") - F.lag("usage_kwh").over(Window.orderBy(*order))})
        found.append(sorted(map(str, plain.select("time", "usage_kwh", "load_type", "usage_diff").collect())))
        for layout in layouts:
            found.append(sorted(map(str, ft.add_rolling(df, layout=layout).select("time", "usage_kwh", "load_type", "usage_diff").collect())))
    assert all(f == found[0] for f in found)


def test_running_sum_and_padding_with_ties(spark):
    small = sr.Layout(rows_per_task=100, hot_factor=0)
    sums, pads = [], []
    for files in (1, 2):
        df = tied(spark, files)
        for layout in (small, PLAIN):
            summed = sr.running_sum_by_date(df, layout=layout).select("time", "usage_kwh", "load_type", F.round("cumulative_daily", 4))
            sums.append(sorted(map(str, summed.collect())))
            gaps = df.withColumn("usage_kwh", F.when(F.col("load_type") != "a", F.col("usage_kwh")))
            pads.append(sorted(map(str, sr.pad_forward(gaps, "usage_kwh", "filled", layout=layout).collect())))
    assert all(s == sums[0] for s in sums) and all(p == pads[0] for p in pads)


def test_outage_leaves_the_closing_parts_small(spark):
    """A gap makes thin slots; those are taken whole, the others keep their share."""
    at = F.col("id") * 60 + F.when(F.col("id") > 10_300, 3_000_000).otherwise(0)
    df = spark.range(0, 20_000).select(F.timestamp_seconds(at + 1_700_000_000).alias("time"), F.col("id").cast("double").alias("usage_kwh"))
    layout = sr.Layout(rows_per_task=1000, hot_factor=10_000)
    slots = sr.count_slots(df, "time", 15, layout)
    assert slots.closing_rows(df, 15).count() < 0.25 * 20_000
    got = sr.over_series(df, lambda w: {"m": sr.trailing_mean("usage_kwh", 16, w)}, 15, ["usage_kwh"], layout=layout)
    assert got.where(F.col("m") != F.col("usage_kwh") - 7.5).count() == 0 and got.where("m is null").count() == 15


def test_no_single_partition_window(raw):
    plan = ft.add_rolling(raw(("2024-01-01 00:00:00", 1.0)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_copies_spread_over_partitions(spark):
    """A third of the rows identical in every column still fill no range partition beyond its share."""
    one = spark.sql("SELECT timestamp'2024-01-01' AS time, 5.0D AS usage_kwh")
    copies = one.crossJoin(spark.range(0, 1000, 1, 4)).drop("id")
    others = spark.range(0, 2000, 1, 4).select(F.timestamp_seconds(F.col("id") * 60 + 1_704_000_000).alias("time"), F.lit(1.0).alias("usage_kwh"))
    indexed = sr.index_series(copies.unionByName(others), layout=sr.Layout(rows_per_task=300))
    sizes = column(indexed.groupBy("_task").count(), "count")
    assert sum(sizes) == 3000 and max(sizes) < 700


def test_pruned_tail_scan(spark, tmp_path):
    """The halo reads the time and the windowed value only; the wide rows cross one exchange."""
    wide = numbers(spark, 600).withColumns({"other": F.lit("x"), "more": F.rand(3)})
    wide.write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    out = sr.over_series(df, lambda w: {"m": sr.trailing_mean("usage_kwh", 16, w)}, 15, ["usage_kwh"], layout=sr.Layout(rows_per_task=100))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<time:timestamp,usage_kwh:double>" in plan
    wide_exchanges = [line for line in plan.splitlines() if "Exchange" in line and "passthrough" in line]
    assert len(wide_exchanges) == 1 and "WindowGroupLimit" in plan


def test_hand_worked_frames(raw):
    df = raw(*[(f"2024-01-01 00:{i * 15:02d}:00" if i < 4 else "2024-01-01 01:00:00", float(i + 1)) for i in range(5)])
    out = ft.add_rolling(df)
    assert column(out, "usage_ma_1h", "time") == [None, None, None, 2.5, 3.5]
    assert column(out, "usage_ma_4h", "time") == [None] * 5
    assert ft.processed_readings(df).count() == 2
    assert ft.processed_readings(df.limit(3)).count() == 0


def test_null_in_frame(raw):
    df = raw(*[(f"2024-01-01 0{i}:00:00", u) for i, u in enumerate([1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0])])
    assert column(ft.add_rolling(df), "usage_ma_1h", "time") == [None] * 5 + [4.5, 5.5]


def test_percent_change(raw):
    df = raw(*[(f"2024-01-01 0{i}:00:00", u) for i, u in enumerate([0.0, 5.0, 10.0])])
    assert column(ft.add_rolling(df), "usage_pct_change", "time") == [None, None, 100.0]
    gap = raw(*[(f"2024-01-01 0{i}:00:00", u) for i, u in enumerate([4.0, None, 6.0])])
    assert column(ft.add_rolling(gap), "usage_pct_change", "time") == [None, None, None]
    assert column(ft.add_rolling(gap, fill="pad"), "usage_pct_change", "time") == [None, 0.0, 50.0]


@pytest.mark.parametrize("layout", [sr.Layout(rows_per_task=40, hot_factor=0), sr.Layout(rows_per_task=7, hot_factor=0), PLAIN])
def test_padding_reaches_far(spark, layout):
    df = numbers(spark, 300, nulls=0.9)
    plain = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    want = sorted(map(tuple, df.select("id", F.last("usage_kwh", ignorenulls=True).over(plain)).collect()))
    got = sr.pad_forward(df, "usage_kwh", "filled", tiebreak=["id"], layout=layout).select("id", "filled")
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("layout", [PLAIN, sr.Layout(rows_per_task=50, hot_factor=0), sr.Layout(rows_per_task=9, hot_factor=0)])
def test_running_sum_restarts_daily(spark, layout):
    df = numbers(spark, 600, crowd=0.3, nulls=0.05)
    per_day = Window.partitionBy(F.to_date("time")).orderBy("time", "id").rowsBetween(Window.unboundedPreceding, 0)
    summed = F.when(F.col("usage_kwh").isNotNull(), F.sum("usage_kwh").over(per_day))
    want = {r[0]: r[1] for r in df.select("id", summed).collect()}
    got = sr.running_sum_by_date(df, tiebreak=["id"], layout=layout)
    assert got.count() == 600
    for r in got.collect():
        assert r.cumulative_daily == (None if want[r.id] is None else pytest.approx(want[r.id], abs=1e-6))


def test_sort_is_whole_and_ordered(spark):
    df = numbers(spark, 500, crowd=0.4)
    up, down = column(sr.sort_series(df), "time"), column(sr.sort_series(df, ascending=False), "time")
    assert up == sorted(up) and len(up) == 500 and down == up[::-1]


def test_reach_must_fit(spark):
    with pytest.raises(ValueError):
        rolled(numbers(spark, 50), sr.Layout(rows_per_task=10, chunk_rows=50, hot_factor=0))


def fine_and_coarse(spark, hot_factor):
    """1,600 readings cut in 160, and the same cuts in eight Spark partitions."""
    df = numbers(spark, 1600, nulls=0.1, crowd=0.02)
    cuts = sr.Layout(rows_per_task=10, chunk_rows=95, hot_factor=hot_factor, rows_per_partition=10)
    return df, cuts, replace(cuts, rows_per_partition=200)


def test_small_cuts_share_range_partitions(spark):
    """Cuts keep their size; range partitions, files and tasks follow the rows, not the cuts."""
    df, apart, shared = fine_and_coarse(spark, 0)
    assert (shared.tasks_for(1600), shared.partitions_for(1600), apart.partitions_for(1600)) == (160, 8, 160)
    indexed = sr.index_series(df, tiebreak=["id"], layout=shared)
    sizes = column(indexed.groupBy("_task").count(), "count")
    assert len(indexed.inputFiles()) <= 8 and 160 <= len(sizes) <= 168 and max(sizes) == 10 and sum(sizes) == 1600
    assert ft.add_rolling(df, tiebreak=["id"], layout=shared).rdd.getNumPartitions() == 8
    assert rolled(df, shared) == rolled(df, apart)


def test_small_cuts_of_running_sums_share_partitions(spark):
    df, apart, shared = fine_and_coarse(spark, 0)
    sums = [sr.running_sum_by_date(df, tiebreak=["id"], layout=layout) for layout in (shared, apart)]
    assert sums[0].rdd.getNumPartitions() == 8
    found = [sorted(map(str, s.select("id", F.round("cumulative_daily", 4)).collect())) for s in sums]
    assert found[0] == found[1] and len(found[0]) == 1600


def test_small_slots_share_partitions(spark):
    """Slots keep their size; the tasks follow the rows, not the slots."""
    df, apart, shared = fine_and_coarse(spark, 10_000)
    assert ft.add_rolling(df, tiebreak=["id"], layout=shared).rdd.getNumPartitions() == 8
    assert len(sr.count_slots(df, "time", 15, shared).counts) > 80
    assert rolled(df, shared) == rolled(df, apart)


def test_small_cuts_of_padding_share_partitions(spark):
    df, apart, shared = fine_and_coarse(spark, 10_000)
    pads = [sr.pad_forward(df, "usage_kwh", "filled", tiebreak=["id"], layout=layout) for layout in (shared, apart)]
    assert pads[0].rdd.getNumPartitions() == 8
    assert sorted(map(tuple, pads[0].select("id", "filled").collect())) == sorted(map(tuple, pads[1].select("id", "filled").collect()))
    assert rolled(df, shared, fill="pad") == rolled(df, apart, fill="pad")
