"""Table layouts, enumerations and parameters of the telemetry model."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and types of the four tables and the message.
RAW_DDL = """
    time timestamp, usage_kwh double, lagging_reactive_power double, leading_reactive_power double,
    co2_tco2 double, lagging_pf double, leading_pf double, nsm int,
    week_status string, day_of_week string, load_type string
"""
DERIVED_DDL = """
    hour int, day int, month int, quarter int, is_weekend boolean,
    shift string, tariff_period string, day_period string,
    usage_ma_1h double, usage_ma_4h double, usage_diff double, usage_pct_change double,
    pf_efficiency double, reactive_power_balance double, low_pf_flag boolean,
    z_score double, z_anomaly boolean, cost_tl double, cost_saving double
"""
PROCESSED_DDL = f"{RAW_DDL}, {DERIVED_DDL}"
ANOMALY_DDL = "time timestamp, usage_kwh double, z_score double, load_type string, detected_at timestamp"
COST_DDL = "time timestamp, usage_kwh double, tariff_type string, cost_tl double, load_type string"

# On the topic the time travels as ISO text.
MESSAGE_DDL = PROCESSED_DDL.replace("time timestamp", "time string", 1)
RAW_MESSAGE_DDL = RAW_DDL.replace("time timestamp", "time string", 1)
# All that scoring reads of a message: the rest need not be decoded.
SCORED_MESSAGE_DDL = "time string, usage_kwh double, load_type string, z_anomaly boolean"


def column_names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(",")]


RAW_COLUMNS = column_names(RAW_DDL)
PROCESSED_COLUMNS = column_names(PROCESSED_DDL)
NUMERIC_COLUMNS = [f.split()[0] for f in RAW_DDL.split(",") if f.split()[1] in ("double", "int")]

# Source CSV header (normalised) -> table column.
CSV_COLUMNS = {
    "date": "time",
    "usage_kwh": "usage_kwh",
    "lagging_current_reactive_power_kvarh": "lagging_reactive_power",
    "leading_current_reactive_power_kvarh": "leading_reactive_power",
    "co2tco2": "co2_tco2",
    "lagging_current_power_factor": "lagging_pf",
    "leading_current_power_factor": "leading_pf",
    "nsm": "nsm",
    "weekstatus": "week_status",
    "day_of_week": "day_of_week",
    "load_type": "load_type",
}

# Enumerations, tariffs, thresholds, physical bounds.
LOAD_TYPES = ("Light_Load", "Medium_Load", "Maximum_Load")
TARIFFS = ("night", "day")
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
NIGHT_TL_PER_KWH = 1.80
DAY_TL_PER_KWH = 3.20
LOW_POWER_FACTOR = 80.0
ROWS_1H, ROWS_4H, ROWS_24H = 4, 16, 96
PHYSICAL_BOUNDS = {
    "usage_kwh": (0.0, 157.18),
    "lagging_reactive_power": (0.0, 80.0),
    "leading_reactive_power": (0.0, 20.0),
    "co2_tco2": (0.0, 0.08),
    "lagging_pf": (0.0, 100.0),
    "leading_pf": (0.0, 100.0),
}
# Colour steps of the dashboard panels, lowest first; below the first the base colour holds.
PANEL_STEPS = {
    "total_anomalies": (("green", 0.0), ("yellow", 50.0), ("red", 200.0)),
    "mean_abs_z": (("#EAB839", 0.0), ("red", 4.0)),
    "max_usage": (("green", 0.0), ("red", 80.0)),
    "hours_since": (("red", 0.0), ("#EAB839", 1.0), ("green", 24.0)),
    "series": (("green", 0.0), ("red", 90.0)),
    "details": (("green", 0.0), ("red", 80.0)),
}
PANEL_BASE_COLOUR = "green"
MESSAGE_FIELDS = ("time", "usage_kwh", "load_type", "tariff_period", "shift", "z_score")


@dataclass(frozen=True)
class ZParams:
    """Historical mean and deviation behind a fixed z-score, and the limits of the anomaly rule."""

    mean: float
    std: float
    upper: float = 3.0
    floor: float = 2.0


# The feature stage and the stream score against different history.
FEATURE_Z = ZParams(mean=27.39, std=33.44)
STREAM_Z = ZParams(mean=35.2, std=27.8)
