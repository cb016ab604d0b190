"""Hand-worked rows for the column functions and filters."""

import math

import pytest
from conftest import column
from pyspark.sql import functions as F

from kilnwatt.functions import calendar as cal
from kilnwatt.functions import measures as m
from kilnwatt.functions.text import day_first_time, iso_time, plain_name
from kilnwatt.operators import filters as flt
from kilnwatt.operators import stats
from kilnwatt.plans import features as ft
from kilnwatt.schemas import FEATURE_Z, PANEL_STEPS, STREAM_Z
from kilnwatt.streaming.jobs import score


def values(spark, items, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return column(df.select("i", make(F.col("v")).alias("out")), "out", "i")


@pytest.mark.parametrize(
    "make, hours, expected",
    [
        (cal.shift_of, [0, 7, 8, 15, 16, 23], ["night_shift"] * 2 + ["day_shift"] * 2 + ["evening_shift"] * 2),
        (cal.tariff_of, [5, 6, 21, 22], ["night", "day", "day", "night"]),
        (cal.day_period_of, [5, 6, 11, 12, 17, 18], ["midnight", "morning", "morning", "afternoon", "afternoon", "evening"]),
    ],
)
def test_hour_bands(spark, make, hours, expected):
    assert values(spark, hours, "int", make) == expected


def test_weekend_and_names(spark):
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"]
    weekend = values(spark, days, "string", lambda v: cal.calendar_parts(v.cast("timestamp"))["is_weekend"])
    names = values(spark, days, "string", lambda v: cal.calendar_text(v.cast("timestamp"))["day_of_week"])
    assert weekend == [False, True, True, False]
    assert names == ["Friday", "Saturday", "Sunday", "Monday"]


def test_anomaly_edges(raw):
    usage = [1.99, 2.0, 127.70, 127.72, None, math.nan]
    df = raw(*[(f"2024-01-01 00:0{i}:00", u) for i, u in enumerate(usage)])
    assert column(ft.add_fixed_z(df), "z_anomaly", "time") == [True, False, False, True, False, False]
    assert column(ft.add_fixed_z(m.nan_to_null(df)), "usage_kwh", "time")[-2:] == [None, None]


def test_low_power_factor(raw):
    df = raw(*[{"time": f"2024-01-01 00:0{i}:00", "lagging_pf": p, "leading_pf": 100.0} for i, p in enumerate([79.99, 80.0, None])])
    wide = ft.add_power_factor(df)
    assert column(wide, "low_pf_flag", "time") == [True, False, False]
    assert column(wide, "pf_efficiency", "time")[1:] == [90.0, None]


def test_costs(raw):
    rows = ft.add_costs(ft.add_calendar(raw(("2024-01-01 12:00:00", 10.0), ("2024-01-01 23:00:00", 10.0)))).orderBy("time").collect()
    assert [(r.cost_tl, round(r.cost_saving, 9)) for r in rows] == [(32.0, 14.0), (18.0, 0.0)]


def test_stream_hour_is_utc(spark, raw):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Istanbul")
    try:
        df = ft.add_calendar(raw(("2024-01-01 23:30:00", 10.0)))
        utc, local = score(df).first(), score(df, zone_mode="session").first()
        assert (utc.hour, utc.tariff_type, utc.tariff_period) == (20.5, "day", "night")
        assert (local.hour, local.tariff_type) == (23.5, "night")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_two_histories(spark):
    assert values(spark, [127.71], "double", lambda v: m.fixed_z(v, FEATURE_Z))[0] == pytest.approx(3.0)
    assert values(spark, [1.0], "double", lambda v: m.fixed_z(v, STREAM_Z))[0] == pytest.approx(-1.2302, abs=1e-4)


def test_clamp_keeps_null(spark):
    assert values(spark, [-1.0, 5.0, 99.0, None], "double", lambda v: m.clamp(v, 0.0, 10.0)) == [0.0, 5.0, 10.0, None]


def test_band_last_step_wins(spark):
    hours = values(spark, [-1.0, 0.0, 0.99, 1.0, 24.0, None], "double", lambda v: m.band(v, PANEL_STEPS["hours_since"]))
    assert hours == ["green", "red", "red", "#EAB839", "green", None]


def test_decimal_rounding(spark):
    assert values(spark, [1.005, 2.675, -1.005], "double", lambda v: m.round_exact(v, 2)) == [1.01, 2.68, -1.01]


def test_names_and_dates(spark):
    assert plain_name(" A b.(C) ") == "a_b_c"
    assert plain_name("Lagging_Current_Reactive.Power_kVarh") == "lagging_current_reactive_power_kvarh"
    parsed = values(spark, ["13/01/2018 00:15", "01/02/2018 5:00", "2018-03-04 01:02:03", "x", None], "string", day_first_time)
    assert [str(p) if p else None for p in parsed] == ["2018-01-13 00:15:00", "2018-02-01 05:00:00", "2018-03-04 01:02:03", None, None]


def test_iso_time(spark):
    shown = values(spark, ["2024-01-01 00:15:00", "2024-01-01 00:15:00.25"], "string", lambda v: iso_time(v.cast("timestamp")))
    assert shown == ["2024-01-01T00:15:00+00:00", "2024-01-01T00:15:00.250000+00:00"]


def test_load_type_choice(raw):
    df = raw(*[{"time": f"2024-01-01 00:0{i}:00", "load_type": t} for i, t in enumerate(["Light_Load", "Medium_Load", None])])
    assert flt.with_load_types(df, None).count() == 3
    assert flt.with_load_types(df, []).count() == 0
    assert flt.with_load_types(df, ["Light_Load"]).count() == 1


def test_routing(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (timestamp'2024-01-01', 1.0D, -1.2D, 'a', true, 'day', 3.2D),
        (timestamp'2024-01-02', 1.0D, -1.2D, 'a', false, 'day', 3.2D), (timestamp'2024-01-03', 1.0D, -1.2D, 'a', null, 'day', null),
        (null, 1.0D, -1.2D, 'a', true, 'day', 3.2D) t(time, usage_kwh, z_score, load_type, z_anomaly, tariff_type, cost_tl)"""
    )
    assert flt.route_anomalies(df).count() == 1
    assert flt.route_costs(df).count() == 2


def test_zero_spread_z_is_null(raw):
    assert column(stats.data_z(raw(("2024-01-01", 5.0), ("2024-01-02", 5.0))), "z_score") == [None, None]
