"""The readings relation derived from an ``events`` table.

One SQL text serves Spark and the SQL checks, so both start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thermolens.session import spread_rows

# Stating the schema saves the job that would read it from the files.
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")

READINGS_SQL = """
WITH b AS (
  SELECT event_id, ts, value, event_type, user_id % 24 AS z, user_id % 120 AS s,
         event_id % 97 AS h, event_id % 53 AS g
  FROM {events})
SELECT CAST(event_id AS BIGINT) AS reading_id,
  ts AS recorded_at,
  concat('B0', CAST(CAST((z - z % 4) / 4 AS INT) + 1 AS VARCHAR(4)),
         '-Z0', CAST(z % 4 + 1 AS VARCHAR(4))) AS building_zone,
  concat('S', lpad(CAST(s + 1 AS VARCHAR(4)), 4, '0')) AS sensor_id,
  CAST(z % 4 + 1 AS INT) AS floor_number,
  CASE WHEN event_id % 25 = 0 OR z = 5 THEN NULL ELSE CAST(h % 46 AS DOUBLE) END AS occupancy_count,
  CAST(18 + g % 19 AS DOUBLE) AS outdoor_temp_c,
  CAST(45 + h % 46 AS DOUBLE) AS outdoor_humidity_pct,
  CAST(g % 31 AS DOUBLE) AS outdoor_pm25_ug_m3,
  CAST(18 + g % 9 + h % 3 + CASE WHEN event_type = 'signup' THEN 8 ELSE 0 END AS DOUBLE) AS indoor_temp_c,
  CAST(45 + g AS DOUBLE) AS indoor_humidity_pct,
  CAST(420 + h * 3 + CASE WHEN event_type = 'error' THEN 700 ELSE 0 END AS DOUBLE) AS co2_ppm,
  CAST((g % 31) * (1 + h % 2) AS DOUBLE) / CAST(2 AS DOUBLE) AS pm25_ug_m3,
  CASE WHEN event_id % 26 = 1 THEN NULL ELSE CAST(60 AS DOUBLE) + value END AS tvoc_ppb,
  CAST(CASE WHEN event_id % 101 = 0 THEN 0 ELSE 600 + h * 20 END AS DOUBLE) AS air_flow_m3_h,
  CAST(800 + h * 8 AS DOUBLE) AS fan_speed_rpm,
  CAST(15 + g AS DOUBLE) AS hvac_power_kw,
  CAST(92 + g + CASE WHEN event_type = 'error' THEN 60 ELSE 0 END AS DOUBLE) AS filter_pressure_pa,
  CASE WHEN event_id % 27 = 2 THEN NULL ELSE CAST(h % 38 AS DOUBLE) END AS vibration_mm_s,
  CAST(1 + h AS INT) AS maintenance_days,
  CASE WHEN event_id % 28 = 3 THEN NULL ELSE CAST(g % 81 AS DOUBLE) END AS window_open_pct,
  CAST(1 + h % 9 AS DOUBLE) AS equipment_age_years,
  concat('v', CAST(event_id % 4 AS VARCHAR(4))) AS firmware_version,
  CASE WHEN event_type = 'error' THEN 'ventilation_issue'
       WHEN event_type = 'signup' THEN 'thermal_issue' ELSE 'normal' END AS diagnostic_state
FROM b
"""


def readings_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(READINGS_SQL, events=events)


def load_readings(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """All readings; with ``spread`` their few raw columns are dealt out before the many derived ones
    are made, in front of work on every row."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")
    return readings_from_events(spark, spread_rows(events) if spread else events)
