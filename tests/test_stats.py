"""Aggregates, exact quantiles and profiles on hand-worked and random rows."""

import random

import numpy as np
import pytest
from conftest import column
from pyspark.sql import functions as F

from kilnwatt.operators import filters as flt
from kilnwatt.operators import stats
from kilnwatt.operators.quantiles import exact_quantiles

SEARCH = {"bins": 3}


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(5)


def samples():
    rng = random.Random(7)
    third = [42.0] * 400 + [rng.gauss(40, 9) for _ in range(800)]
    return {
        "uniform": [rng.random() for _ in range(1500)],
        "a third equal": third,
        "two values": [0.0] * 500 + [1.0] * 500,
        "heavy tail": [rng.paretovariate(0.4) for _ in range(1000)],
        "one value": [3.5] * 300,
        "few": [1.0, 2.0, 3.0, 4.0],
        "signs": [-1e300, -1.0, -0.0, 0.0, 1e-300, 5.0, 1e300],
    }


@pytest.mark.parametrize("name", samples())
@pytest.mark.parametrize("limits", [{}, SEARCH])
def test_quantiles_are_exact(spark, name, limits):
    values, probabilities = samples()[name], [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(frame(spark, values + [None, float("nan")]), ["v"], probabilities, **limits).first()["v"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_quantiles_mix_and_empty(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("many"), (F.col("id") % 3).cast("double").alias("few"), F.lit(None).cast("double").alias("none"))
    got = exact_quantiles(df, ["many", "few", "none"], [0.5], bins=4).first()
    assert (got["many"], got["few"], got["none"]) == ([499.5], [1.0], None)


def test_fences(spark):
    fences = flt.iqr_fences(frame(spark, [1.0, 2.0, 3.0, 4.0]), "v").first()
    assert (fences.q1, fences.q3, fences.lower, fences.upper) == (1.75, 3.25, -0.5, 5.5)


def test_histogram_closes_last_bin(spark):
    bins = stats.histogram(frame(spark, [float(i) for i in range(11)]), "v", 5)
    assert column(bins, "rows", "bin") == [2, 2, 2, 2, 3]
    assert column(stats.histogram(frame(spark, [4.0, 4.0]), "v", 4), "rows", "bin") == [0, 0, 2, 0]
    assert stats.histogram(frame(spark, [None]), "v", 4).count() == 0


def test_boxplot(spark):
    box = stats.boxplot(frame(spark, [1.0, 2.0, 3.0, 4.0, 100.0]), "v").first()
    assert (box.whisker_low, box.whisker_high, box.fliers) == (1.0, 4.0, 1)


def test_peak_tie_takes_first_hour(spark):
    hourly = spark.createDataFrame([(2, 5.0), (1, 5.0), (3, None)], "hour int, mean_usage double")
    peak = stats.peak_and_trough(hourly).first()
    assert (peak.peak_hour, peak.trough_hour) == (1, 1)


def test_date_spine(raw):
    out = stats.daily_resample(raw(("2024-01-01 10:00:00", 4.0), ("2024-01-03 11:00:00", 6.0))).collect()
    assert [(str(r.day), r.mean_usage) for r in out] == [("2024-01-01", 4.0), ("2024-01-02", None), ("2024-01-03", 6.0)]


def test_rates_of_nothing(spark, raw):
    empty = spark.createDataFrame([], "z_anomaly boolean")
    assert stats.flagged_rate(empty).first()["rate_pct"] is None


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b")], "v double, s string")
    assert dict(map(tuple, stats.null_profile(df).collect())) == {"v": 2, "s": 1}


def test_describe_rounds(spark):
    row = stats.describe(frame(spark, [1.0, 2.0, 4.0]), ["v"]).first()
    assert (row["count"], row["mean"], row["std"], row["q25"], row["q50"], row["q75"]) == (3, 2.33, 1.53, 1.5, 2.0, 3.0)


def test_hot_days(raw):
    rows = [(f"2024-01-{d:02d} 08:00:00", 100.0 if d == 9 else 10.0) for d in range(1, 21)]
    hot = stats.hot_days(raw(*rows)).collect()
    assert [(str(r.day), r.hot_days) for r in hot] == [("2024-01-09", 1)]


def test_observed_metrics(spark):
    df, metrics = stats.observed(spark.range(10), "seen", rows=F.count(F.lit(1)), high=F.count_if(F.col("id") > 6))
    df.write.format("noop").mode("overwrite").save()
    assert metrics.get == {"rows": 10, "high": 3}


def test_infinity_is_left_out(spark):
    df = frame(spark, [1.0, 2.0, 3.0, float("inf"), float("-inf"), float("nan"), None])
    row = stats.describe(df, ["v"]).first()
    assert (row["count"], row["mean"], row["max"]) == (3, 2.0, 3.0)
    assert column(stats.histogram(df, "v", 2), "rows", "bin") == [1, 2]


def test_quantile_tasks_do_not_grow_with_the_input(spark):
    """Values are counted before they meet, and each pass groups by bin: no exchange into a single task."""
    many = spark.range(0, 20_000, 1, 64).select((F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    assert exact_quantiles(many, ["v"], [0.5]).first()["v"] == [float(np.median([i * 7919 % 20_011 for i in range(20_000)]))]
