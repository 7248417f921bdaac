"""The readings relation: schema, column groups and label order."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, types and order of the 24 columns of a raw readings file.
RAW_SCHEMA = T.StructType([
    T.StructField("reading_id", T.LongType()),
    T.StructField("recorded_at", T.StringType()),
    T.StructField("building_zone", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("floor_number", T.IntegerType()),
    T.StructField("occupancy_count", T.DoubleType()),
    T.StructField("outdoor_temp_c", T.DoubleType()),
    T.StructField("outdoor_humidity_pct", T.DoubleType()),
    T.StructField("outdoor_pm25_ug_m3", T.DoubleType()),
    T.StructField("indoor_temp_c", T.DoubleType()),
    T.StructField("indoor_humidity_pct", T.DoubleType()),
    T.StructField("co2_ppm", T.DoubleType()),
    T.StructField("pm25_ug_m3", T.DoubleType()),
    T.StructField("tvoc_ppb", T.DoubleType()),
    T.StructField("air_flow_m3_h", T.DoubleType()),
    T.StructField("fan_speed_rpm", T.DoubleType()),
    T.StructField("hvac_power_kw", T.DoubleType()),
    T.StructField("filter_pressure_pa", T.DoubleType()),
    T.StructField("vibration_mm_s", T.DoubleType()),
    T.StructField("maintenance_days", T.IntegerType()),
    T.StructField("window_open_pct", T.DoubleType()),
    T.StructField("equipment_age_years", T.DoubleType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("diagnostic_state", T.StringType()),
])

ZONE = "building_zone"
TARGET = "diagnostic_state"
TIME = "recorded_at"
ID = "reading_id"

# Class names, in the order of their integer codes 0, 1, 2.
LABELS = ("normal", "ventilation_issue", "thermal_issue")

# Column groups, in feature-vector order.
IMPUTED = ("occupancy_count", "tvoc_ppb", "vibration_mm_s", "window_open_pct")
PHYSICAL = (
    "indoor_temp_c", "outdoor_temp_c", "indoor_humidity_pct", "outdoor_humidity_pct",
    "pm25_ug_m3", "outdoor_pm25_ug_m3", "filter_pressure_pa", "air_flow_m3_h", "hvac_power_kw",
)
DELTAS = ("delta_temp_c", "delta_humidity_pct")
RATIOS = ("pm25_indoor_outdoor_ratio", "filter_pressure_per_airflow", "hvac_kw_per_airflow")
ENGINEERED = DELTAS + RATIOS
EQUIPMENT = ("co2_ppm", "fan_speed_rpm", "maintenance_days", "equipment_age_years")

MODEL_FEATURES = ("floor_number",) + IMPUTED + PHYSICAL + EQUIPMENT + ENGINEERED
ZONE_INDEX = "building_zone_idx"
VECTOR_FEATURES = MODEL_FEATURES + (ZONE_INDEX,)

# Inputs of the engineered columns.
DELTA_INPUTS = {
    "delta_temp_c": ("indoor_temp_c", "outdoor_temp_c"),
    "delta_humidity_pct": ("indoor_humidity_pct", "outdoor_humidity_pct"),
}
RATIO_INPUTS = {
    "pm25_indoor_outdoor_ratio": ("pm25_ug_m3", "outdoor_pm25_ug_m3"),
    "filter_pressure_per_airflow": ("filter_pressure_pa", "air_flow_m3_h"),
    "hvac_kw_per_airflow": ("hvac_power_kw", "air_flow_m3_h"),
}

# What a scoring request uses for a sensor column it does not carry.
SCORING_DEFAULTS = {
    "building_zone": "B01-Z01",
    "floor_number": 1,
    "occupancy_count": 10.0,
    "outdoor_temp_c": 15.0,
    "outdoor_humidity_pct": 60.0,
    "outdoor_pm25_ug_m3": 10.0,
    "indoor_temp_c": 22.0,
    "indoor_humidity_pct": 50.0,
    "co2_ppm": 600.0,
    "pm25_ug_m3": 15.0,
    "tvoc_ppb": 120.0,
    "air_flow_m3_h": 1000.0,
    "fan_speed_rpm": 1200.0,
    "hvac_power_kw": 5.0,
    "filter_pressure_pa": 100.0,
    "vibration_mm_s": 1.5,
    "maintenance_days": 30,
    "window_open_pct": 0.0,
    "equipment_age_years": 3.0,
}

SCORING_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType) for f in RAW_SCHEMA if f.name in SCORING_DEFAULTS]
    + [T.StructField(c, T.DoubleType()) for c in ENGINEERED]
    + [T.StructField(TARGET, T.StringType())]
)

# Plausible range of each operator-entered quantity (inclusive).
VALID_RANGES = {
    "floor_number": (1, 4),
    "occupancy_count": (0, 300),
    "indoor_temp_c": (14.0, 42.0),
    "outdoor_temp_c": (-5.0, 45.0),
    "co2_ppm": (300, 2500),
    "pm25_ug_m3": (0.0, 200.0),
    "indoor_humidity_pct": (20.0, 95.0),
    "air_flow_m3_h": (100.0, 4000.0),
    "filter_pressure_pa": (40.0, 300.0),
    "hvac_power_kw": (0.5, 25.0),
    "fan_speed_rpm": (400.0, 2500.0),
    "vibration_mm_s": (0.2, 10.0),
    "maintenance_days": (0, 500),
}
