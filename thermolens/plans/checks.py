"""SQL with the same results as the registered queries, for an independent engine.

Each text is standard SQL over the given tables; it states the result directly and shares no code
with the Spark operators except the text of the derived ``readings`` relation.
"""

from __future__ import annotations

from thermolens.sources.fixture import READINGS_SQL

# Everything that the SQL states is written out here, apart from the code it checks.
CUTOFF, FIRST_ROWS, RATIO_DIGITS = "2024-01-24", 5000, 8
# Columns, classes, ranges, presentation and weights, as in the specification.
RAW = (
    "reading_id recorded_at building_zone sensor_id floor_number occupancy_count outdoor_temp_c "
    "outdoor_humidity_pct outdoor_pm25_ug_m3 indoor_temp_c indoor_humidity_pct co2_ppm pm25_ug_m3 "
    "tvoc_ppb air_flow_m3_h fan_speed_rpm hvac_power_kw filter_pressure_pa vibration_mm_s "
    "maintenance_days window_open_pct equipment_age_years firmware_version diagnostic_state").split()
IMPUTED = ("occupancy_count", "tvoc_ppb", "vibration_mm_s", "window_open_pct")
PHYSICAL = (
    "indoor_temp_c outdoor_temp_c indoor_humidity_pct outdoor_humidity_pct pm25_ug_m3 "
    "outdoor_pm25_ug_m3 filter_pressure_pa air_flow_m3_h hvac_power_kw").split()
RATIO_INPUTS = {
    "pm25_indoor_outdoor_ratio": ("pm25_ug_m3", "outdoor_pm25_ug_m3"),
    "filter_pressure_per_airflow": ("filter_pressure_pa", "air_flow_m3_h"),
    "hvac_kw_per_airflow": ("hvac_power_kw", "air_flow_m3_h"),
}
RATIOS = tuple(RATIO_INPUTS)
ENGINEERED = ("delta_temp_c", "delta_humidity_pct", *RATIOS)
MODEL_FEATURES = ("floor_number", *IMPUTED, *PHYSICAL, "co2_ppm", "fan_speed_rpm",
                  "maintenance_days", "equipment_age_years", *ENGINEERED)
VECTOR_FEATURES = (*MODEL_FEATURES, "building_zone_idx")
SCORING_COLUMNS = (
    "building_zone floor_number occupancy_count outdoor_temp_c outdoor_humidity_pct "
    "outdoor_pm25_ug_m3 indoor_temp_c indoor_humidity_pct co2_ppm pm25_ug_m3 tvoc_ppb "
    "air_flow_m3_h fan_speed_rpm hvac_power_kw filter_pressure_pa vibration_mm_s "
    "maintenance_days window_open_pct equipment_age_years").split()
LABELS = ("normal", "ventilation_issue", "thermal_issue")
LABEL_ATTRIBUTES = {
    "normal": ("Normal", "#22C55E"), "ventilation_issue": ("Ventilation issue", "#EF4444"),
    "thermal_issue": ("Thermal issue", "#F59E0B"),
}
TOP_IMPORTANCES = {
    "co2_ppm": 22, "filter_pressure_pa": 18, "delta_temp_c": 15, "indoor_temp_c": 12,
    "air_flow_m3_h": 10, "pm25_indoor_outdoor_ratio": 8,
}
VALID_RANGES = {
    "floor_number": (1, 4), "occupancy_count": (0, 300), "indoor_temp_c": (14, 42),
    "outdoor_temp_c": (-5, 45), "co2_ppm": (300, 2500), "pm25_ug_m3": (0, 200),
    "indoor_humidity_pct": (20, 95), "air_flow_m3_h": (100, 4000),
    "filter_pressure_pa": (40, 300), "hvac_power_kw": (0.5, 25), "fan_speed_rpm": (400, 2500),
    "vibration_mm_s": (0.2, 10), "maintenance_days": (0, 500),
}

BEFORE = f"recorded_at < TIMESTAMP '{CUTOFF} 00:00:00'"
SIDE = f"CASE WHEN {BEFORE} THEN 'train' ELSE 'test' END AS split"
READINGS = f"WITH readings AS ({READINGS_SQL.format(events='events')})"
DOUBLES = {*IMPUTED, *PHYSICAL, *ENGINEERED, "co2_ppm", "fan_speed_rpm", "equipment_age_years"}


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name or expression}"


def pick(names, digits: int = 6) -> str:
    return ", ".join(r(n, n, digits) if n in DOUBLES else n for n in names)


DELTA_SQL = ("indoor_temp_c - outdoor_temp_c AS delta_temp_c, "
             "indoor_humidity_pct - outdoor_humidity_pct AS delta_humidity_pct")


def ratio_sql(policy: str = "null") -> str:
    parts = []
    for out, (num, den) in RATIO_INPUTS.items():
        if policy == "null":
            parts.append(f"CASE WHEN {den} > 0 THEN {num} / {den} END AS {out}")
        elif policy == "add_epsilon":
            parts.append(f"{num} / ({den} + CAST(0.00001 AS DOUBLE)) AS {out}")
        else:
            parts.append(f"{num} / CASE WHEN {den} > 0 THEN {den} "
                         f"ELSE CAST(0.00001 AS DOUBLE) END AS {out}")
    return ", ".join(parts)


def medians(source: str, columns, name: str) -> str:
    """Grouped and global medians of ``source`` as {name}_g and {name}_t."""
    cols = ", ".join(f"median({c}) AS m_{c}" for c in columns)
    return (f"{name}_g AS (SELECT building_zone, {cols} FROM {source} GROUP BY building_zone), "
            f"{name}_t AS (SELECT {cols} FROM {source})")


def fill(source: str, columns, name: str) -> str:
    repl = ", ".join(f"coalesce(s.{c}, g.m_{c}, t.m_{c}) AS {c}" for c in columns)
    return (f"SELECT s.* REPLACE ({repl}) FROM {source} s "
            f"LEFT JOIN {name}_g g ON s.building_zone = g.building_zone, {name}_t t")


TRAIN = f"{READINGS}, train AS (SELECT * FROM readings WHERE {BEFORE})"
FILLED = (f"{TRAIN}, {medians('train', IMPUTED, 'im')}, "
          f"filled AS ({fill('readings', IMPUTED, 'im')}), "
          f"feat AS (SELECT *, {DELTA_SQL}, {ratio_sql()} FROM filled)")
FULL = (f"{FILLED}, ftrain AS (SELECT * FROM feat WHERE {BEFORE}), "
        f"{medians('ftrain', RATIOS, 'rm')}, "
        f"whole AS ({fill('feat', RATIOS, 'rm')}), "
        "zones AS (SELECT building_zone AS zone_name, "
        "row_number() OVER (ORDER BY building_zone) - 1 AS zone_no "
        "FROM (SELECT DISTINCT building_zone FROM train)), "
        "vec AS (SELECT w.*, CAST(coalesce(z.zone_no, (SELECT count(*) FROM zones)) AS DOUBLE) "
        "AS building_zone_idx, z.zone_name AS active_zone "
        "FROM whole w LEFT JOIN zones z ON w.building_zone = z.zone_name), "
        f"vtrain AS (SELECT * FROM vec WHERE {BEFORE})")
STATS = (FULL + ", stats AS (SELECT "
         + ", ".join(f"stddev_samp({c}) AS s_{c}, avg({c}) AS a_{c}" for c in VECTOR_FEATURES)
         + " FROM vtrain)")
SCALED = ", ".join(r(f"{c} / s_{c}", c) for c in VECTOR_FEATURES)

RULE = ("CASE WHEN co2_ppm > 1100 OR filter_pressure_pa > 135 OR pm25_ug_m3 / "
        "CASE WHEN outdoor_pm25_ug_m3 > 0 THEN outdoor_pm25_ug_m3 ELSE CAST(0.00001 AS DOUBLE) END "
        "> 2.5 THEN 'ventilation_issue' "
        "WHEN abs(indoor_temp_c - outdoor_temp_c) > 14 OR indoor_temp_c > 28.5 "
        "OR (hvac_power_kw > 6.0 AND indoor_temp_c > 26.0) THEN 'thermal_issue' "
        "ELSE 'normal' END")
RULED = f"{READINGS}, ruled AS (SELECT *, {RULE} AS predicted FROM readings)"
CODES = """CASE predicted
  WHEN 'ventilation_issue' THEN coalesce(nullif(concat_ws(',',
    CASE WHEN filter_pressure_pa > 120 THEN 'clogged_filter' END,
    CASE WHEN co2_ppm > 1000 THEN 'high_co2' END,
    CASE WHEN air_flow_m3_h < 300 THEN 'low_air_flow' END), ''), 'ventilation_check')
  WHEN 'thermal_issue' THEN coalesce(nullif(concat_ws(',',
    CASE WHEN indoor_temp_c > 27 THEN 'overheated_room' END,
    CASE WHEN abs(indoor_temp_c - outdoor_temp_c) > 12 THEN 'large_temperature_gap' END,
    CASE WHEN hvac_power_kw > 6 THEN 'peak_hvac_load' END), ''), 'thermal_check')
  ELSE 'all_good,keep_schedule' END"""
HASH = "((CAST(reading_id AS BIGINT) % 2147483648) * 2654435761) % 4294967296"
BUCKET = f"floor(({HASH}) * 10000 / CAST(4294967296 AS DOUBLE))"
BY_LABEL = ", ".join(f"('{label}')" for label in LABELS)
CORR_NAMES = [*ENGINEERED, *[f"state_{label}" for label in LABELS]]
INDICATORS = ", ".join(f"CASE WHEN diagnostic_state = '{label}' THEN CAST(1 AS DOUBLE) "
                       f"ELSE CAST(0 AS DOUBLE) END AS state_{label}" for label in LABELS)
CORR_INPUT = (f"{TRAIN}, f AS (SELECT *, {DELTA_SQL}, {ratio_sql()}, {INDICATORS} FROM train)")


def corr(a: str, b: str) -> str:
    return (f"CASE WHEN isnan(coalesce(corr({a}, {b}), 0)) THEN 0 "
            f"ELSE coalesce(corr({a}, {b}), 0) END")


CLASS_COUNTS = (f"{RULED}, labels_list(label) AS (VALUES {BY_LABEL}), "
                "c AS (SELECT label, "
                "(SELECT count(*) FROM ruled WHERE diagnostic_state = label AND predicted = label) AS tp, "
                "(SELECT count(*) FROM ruled WHERE diagnostic_state = label) AS support, "
                "(SELECT count(*) FROM ruled WHERE predicted = label) AS called FROM labels_list), "
                "s AS (SELECT label, support, "
                "coalesce(CAST(tp AS DOUBLE) / nullif(called, 0), 0) AS prec, "
                "coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS rec, "
                "coalesce(2 * CAST(tp AS DOUBLE) / nullif(called + support, 0), 0) AS f1, tp FROM c)")
BUILDING = "split_part(building_zone, '-', 1)"


def rollup_sql(names: dict[str, str] | None = None) -> str:
    names = names or {}

    def n(x: str) -> str:
        return f'"{names.get(x, x)}"'
    share = ", ".join(
        f"round(100 * avg(CASE WHEN diagnostic_state = '{label}' THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) "
        f"AS {n(out)}" for label, out in zip(LABELS, ("normal_pct", "ventilation_pct", "thermal_pct")))
    normal = "100 * avg(CASE WHEN diagnostic_state = 'normal' THEN CAST(1 AS DOUBLE) ELSE 0 END)"
    return (f"{READINGS} SELECT {BUILDING} AS {n('building')}, "
            f"count(DISTINCT building_zone) AS {n('zones')}, "
            f"count(DISTINCT sensor_id) AS {n('sensors')}, {share}, "
            f"CASE WHEN {normal} >= 65 THEN 'low' WHEN {normal} >= 60 THEN 'medium' "
            f"ELSE 'alert' END AS {n('risk')} FROM readings GROUP BY {BUILDING}")


def frequency_index() -> str:
    return ("SELECT diagnostic_state, n, CAST(row_number() OVER (ORDER BY n DESC, diagnostic_state) "
            "- 1 AS DOUBLE) AS label FROM (SELECT diagnostic_state, count(*) AS n FROM readings "
            "GROUP BY diagnostic_state)")


def _coerce_checks() -> str:
    bad = "CASE WHEN reading_id % 10 < 4 THEN NULL ELSE tvoc_ppb END"
    columns = [r(bad, c) if c == "tvoc_ppb" else r(c) for c in (*IMPUTED, *PHYSICAL)]
    return f"{READINGS} SELECT reading_id, {', '.join(columns)} FROM readings"


def _schema_checks() -> str:
    columns = []
    for name in (*SCORING_COLUMNS, *ENGINEERED, "diagnostic_state"):
        if name in ENGINEERED:
            columns.append(f"CAST(NULL AS DOUBLE) AS {name}")
        elif name == "fan_speed_rpm":
            columns.append("CASE WHEN reading_id % 50 = 0 THEN NULL ELSE fan_speed_rpm END "
                           "AS fan_speed_rpm")
        else:
            columns.append(pick([name]))
    return f"{READINGS} SELECT reading_id, {', '.join(columns)} FROM readings"


def _stacked(source: str, rows: list[str], head: str = READINGS) -> str:
    return head + " " + " UNION ALL ".join(f"SELECT {row} FROM {source}" for row in rows)


def _crossover() -> str:
    return (f"{READINGS}, t AS (SELECT {BUILDING} AS building, CAST(maintenance_days AS DOUBLE) AS x, "
            "avg(indoor_temp_c) - avg(outdoor_temp_c) AS g FROM readings "
            f"GROUP BY {BUILDING}, maintenance_days), "
            "l AS (SELECT *, lead(x) OVER w AS x2, lead(g) OVER w AS g2 FROM t "
            "WINDOW w AS (PARTITION BY building ORDER BY x)) "
            "SELECT building, round(CASE WHEN g = 0 THEN x ELSE x + (x2 - x) * g / (g - g2) END, 6) "
            "AS crossover_size FROM l WHERE g * g2 < 0 OR g = 0")


def _contributions() -> str:
    head = (f"{READINGS}, f AS (SELECT *, {DELTA_SQL}, {ratio_sql('clamp_epsilon')} FROM readings)")
    rows = [f"reading_id, {i} AS position, '{name}' AS feature, round({name}, 2) + 0.0 AS value, "
            f"CAST({weight} AS DOUBLE) AS importance"
            for i, (name, weight) in enumerate(TOP_IMPORTANCES.items(), 1)]
    return _stacked("f", rows, head)


CHECKS: dict[str, str] = {
    "scan_parquet": "SELECT * REPLACE (round(l_quantity, 6) AS l_quantity, "
                    "round(l_extendedprice, 6) AS l_extendedprice, "
                    "round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax) FROM lineitem",
    "scan_csv_roundtrip": f"{READINGS} SELECT {pick(RAW)} FROM readings",
    "scan_csv_inferred": f"{READINGS} SELECT {pick([c for c in RAW if c != 'recorded_at'])}, "
                         "19 AS n_numbers FROM readings",
    "daily_feature_table": f"{READINGS}, feat AS (SELECT *, {DELTA_SQL}, {ratio_sql()} FROM readings) "
                           "SELECT reading_id, recorded_at, building_zone, "
                           f"{pick(ENGINEERED, RATIO_DIGITS)} FROM feat WHERE {BEFORE}",
    "building_rollup_merged": rollup_sql(),
    "first_n_rows": f"{READINGS} SELECT reading_id, recorded_at, building_zone FROM readings "
                    f"ORDER BY recorded_at, reading_id LIMIT {FIRST_ROWS}",
    "feature_metadata": _stacked("stats", [
        f"CAST({i} AS INT) AS position, '{c}' AS feature, {str(c in IMPUTED).lower()} AS imputed, "
        f"{str(c in ENGINEERED).lower()} AS engineered, round(s_{c}, 6) AS scale"
        for i, c in enumerate(VECTOR_FEATURES)], STATS),
    "coerce_schema": _schema_checks(),
    "guard_report": f"{TRAIN} SELECT count(*) AS n_rows, "
                    "count(*) FILTER (WHERE building_zone IS NULL) AS null_keys, "
                    + ", ".join(f"count({c}) AS observed_{c}" for c in IMPUTED) + " FROM train",
    "coerce_numeric": _coerce_checks(),
    "drop_columns": f"{READINGS} SELECT "
                    f"{pick([c for c in RAW if c not in ('reading_id', 'firmware_version')])} "
                    "FROM readings",
    "rename_columns": rollup_sql({
        "building": "Building", "zones": "Zones", "sensors": "Sensors", "normal_pct": "Normal",
        "ventilation_pct": "Ventilation", "thermal_pct": "Thermal", "risk": "Risk"}),
    "delta_features": f"{READINGS} SELECT reading_id, {DELTA_SQL} FROM readings",
    **{name: f"{READINGS}, f AS (SELECT reading_id, {ratio_sql(policy)} FROM readings) "
             f"SELECT reading_id, {pick(RATIOS, RATIO_DIGITS)} FROM f"
       for name, policy in (("ratio_features", "null"),
                            ("ratio_features_add_epsilon", "add_epsilon"),
                            ("ratio_features_clamp_epsilon", "clamp_epsilon"))},
    "enrich_idempotent": f"{READINGS}, f AS (SELECT *, {ratio_sql()} FROM readings) "
                         "SELECT reading_id, CAST(floor_number AS DOUBLE) AS delta_temp_c, "
                         "indoor_humidity_pct - outdoor_humidity_pct AS delta_humidity_pct, "
                         f"{pick(RATIOS[:2], RATIO_DIGITS)} FROM f",
    "parse_timestamp": f"{READINGS} SELECT reading_id, "
                       "CASE WHEN reading_id % 17 <> 0 THEN recorded_at END AS recorded_at, "
                       "reading_id % 17 <> 0 AS is_valid FROM readings",
    "convert_timezone": f"{READINGS} SELECT reading_id, recorded_at + INTERVAL 7 HOUR AS local_at "
                        "FROM readings",
    "label_indicators": f"{READINGS} SELECT reading_id, {INDICATORS} FROM readings",
    "label_encode": f"{READINGS} SELECT reading_id, diagnostic_state, CAST(CASE diagnostic_state "
                    "WHEN 'normal' THEN 0 WHEN 'ventilation_issue' THEN 1 ELSE 2 END AS INT) "
                    "AS label_code FROM readings",
    "apply_defaults": f"{READINGS} SELECT reading_id, CAST(120 AS DOUBLE) AS tvoc_ppb, "
                      "CAST(1200 AS DOUBLE) AS fan_speed_rpm, CAST(30 AS INT) AS maintenance_days, "
                      "CAST(1.5 AS DOUBLE) AS vibration_mm_s, occupancy_count, window_open_pct "
                      "FROM readings",
    "sensor_bands": f"{READINGS} SELECT reading_id, "
                    "CASE WHEN co2_ppm < 1000 THEN 'safe' WHEN co2_ppm < 1400 THEN 'warning' "
                    "ELSE 'danger' END AS co2_ppm_band, "
                    "CASE WHEN pm25_ug_m3 < 35 THEN 'good' WHEN pm25_ug_m3 < 75 THEN 'moderate' "
                    "ELSE 'polluted' END AS pm25_ug_m3_band, "
                    "CASE WHEN filter_pressure_pa < 125 THEN 'clean' ELSE 'clogged' END "
                    "AS filter_pressure_pa_band FROM readings",
    "range_violations": _stacked("readings", [
        f"'{c}' AS column_name, count(*) FILTER (WHERE {c} < {low}) AS below, "
        f"count(*) FILTER (WHERE {c} > {high}) AS above" for c, (low, high) in VALID_RANGES.items()]),
    "parse_zone": f"{READINGS} SELECT reading_id, {BUILDING} AS building, "
                  "split_part(building_zone, '-', 2) AS zone, "
                  "CAST(replace(split_part(building_zone, '-', 2), 'Z', '') AS INT) AS zone_floor "
                  "FROM readings",
    "feature_projection": f"{READINGS}, f AS (SELECT *, {DELTA_SQL}, {ratio_sql()} FROM readings) "
                          f"SELECT building_zone, diagnostic_state, {pick(MODEL_FEATURES, RATIO_DIGITS)} FROM f",
    "split_by_cutoff": f"{READINGS} SELECT reading_id, CASE WHEN {BEFORE} THEN 'train' "
                       "ELSE 'test' END AS split FROM readings",
    "split_by_rank": f"{READINGS} SELECT reading_id, CASE WHEN row_number() OVER "
                     "(ORDER BY recorded_at, reading_id) <= floor(0.8 * count(*) OVER ()) "
                     "THEN 'train' ELSE 'test' END AS split FROM readings",
    "stratified_split": f"{READINGS} SELECT reading_id, diagnostic_state, CASE WHEN row_number() "
                        f"OVER (PARTITION BY diagnostic_state ORDER BY {HASH}, reading_id) <= "
                        "floor(CAST(0.8 AS DOUBLE) * count(*) OVER (PARTITION BY diagnostic_state)) "
                        "THEN 'train' ELSE 'test' END AS split FROM readings",
    "hash_sample": f"{READINGS} SELECT reading_id FROM readings WHERE {BUCKET} < 1500",
    "hash_split": f"{READINGS} SELECT reading_id, CASE WHEN {BUCKET} < 8000 THEN 'train' "
                  "ELSE 'test' END AS split FROM readings",
    "group_median_impute": f"{FILLED} SELECT reading_id, {pick(IMPUTED)} FROM filled",
    "fit_train_apply_test": f"{FILLED} SELECT reading_id, "
                                 f"{pick((*IMPUTED, *ENGINEERED), RATIO_DIGITS)}, {SIDE} FROM feat",
    "feature_job_outputs": f"{FILLED} SELECT reading_id, "
                           f"{pick((*IMPUTED, *ENGINEERED), RATIO_DIGITS)}, {SIDE} FROM feat",
    "zone_dimension": f"{READINGS}, b AS (SELECT DISTINCT {BUILDING} AS building FROM readings), "
                      "g AS (SELECT building, 'Z0' || CAST(i AS VARCHAR) AS zone FROM b, range(1, 5) t(i)) "
                      "SELECT building, zone, building || '-' || zone AS building_zone, "
                      "(SELECT count(*) FROM readings r WHERE r.building_zone = building || '-' || zone) "
                      "AS n_readings FROM g",
    "row_count_limit": f"{READINGS} SELECT count(*) AS n_rows, CAST(8000 AS BIGINT) AS row_limit, "
                       "count(*) > 8000 AS over_limit, "
                       "CAST(greatest(count(*) - 8000, 0) AS BIGINT) AS overflow_rows FROM readings",
    "label_distribution": f"{READINGS} SELECT diagnostic_state, count(*) AS n, "
                          "round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 2) "
                          "AS percentage FROM readings GROUP BY diagnostic_state",
    "null_profile": _stacked("readings", [
        f"'{c}' AS column_name, count(*) - count({c}) AS n_null" for c in RAW]),
    "null_profile_by_zone": f"{READINGS} SELECT building_zone, "
                            + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in IMPUTED)
                            + " FROM readings GROUP BY building_zone",
    "label_by_firmware": f"{READINGS} SELECT firmware_version, diagnostic_state, count(*) AS n "
                         "FROM readings GROUP BY firmware_version, diagnostic_state",
    "global_median": f"{READINGS} SELECT "
                     + ", ".join(r(f"median({c})", c) for c in IMPUTED) + " FROM readings",
    "group_median": f"{READINGS}, {medians('readings', IMPUTED, 'm')} SELECT g.building_zone, "
                    + ", ".join(r(f"coalesce(g.m_{c}, t.m_{c})", c) for c in IMPUTED)
                    + " FROM m_g g, m_t t",
    "order_price_median": "SELECT o_orderstatus, round(median(o_totalprice), 6) AS o_totalprice "
                          "FROM orders GROUP BY o_orderstatus",
    "group_observed_count": f"{READINGS} SELECT building_zone, "
                            + ", ".join(f"count({c}) AS observed_{c}" for c in IMPUTED)
                            + " FROM readings GROUP BY building_zone",
    "zone_summary": f"{READINGS} SELECT building_zone, {r('avg(indoor_temp_c)', 'avg_temp')}, "
                    f"{r('avg(hvac_power_kw)', 'avg_power')}, count(*) AS n FROM readings "
                    "GROUP BY building_zone",
    "label_index_counts": f"{READINGS} SELECT label, n FROM ({frequency_index()})",
    "column_average": f"{READINGS} SELECT {r('avg(indoor_temp_c)', 'avg_indoor_temp_c')} FROM readings",
    "correlation_matrix": _stacked("f", [
        f"'{a}' AS a, '{b}' AS b, {r(corr(a, b), 'r')}" for a in CORR_NAMES for b in CORR_NAMES],
        CORR_INPUT),
    "feature_class_association": CORR_INPUT + ", c AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, " + ", ".join(
            f"{corr(f, 'state_' + label)} AS state_{label}" for label in LABELS) + " FROM f"
        for f in ENGINEERED) + ") SELECT feature, "
        + ", ".join(r(f"state_{label}") for label in LABELS) + ", round(greatest("
        + ", ".join(f"abs(state_{label})" for label in LABELS)
        + "), 6) AS max_abs_class_correlation FROM c",
    "split_time_range": f"{READINGS} SELECT CASE WHEN {BEFORE} THEN 'train' ELSE 'test' END AS split, "
                        "min(recorded_at) AS first_at, max(recorded_at) AS last_at, count(*) AS n "
                        "FROM readings GROUP BY 1",
    "building_rollup": rollup_sql(),
    "floor_issue_rate": f"{READINGS}, t AS (SELECT floor_number, 100 * avg(CASE WHEN diagnostic_state "
                        "= 'thermal_issue' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS p FROM readings "
                        "GROUP BY floor_number), b AS (SELECT p AS base FROM t ORDER BY floor_number "
                        "LIMIT 1) SELECT floor_number, round(p, 6) AS issue_pct, "
                        "round((p - base) / base * 100, 6) + 0.0 AS rise_pct FROM t, b",
    "confusion_matrix": f"{RULED} SELECT diagnostic_state AS actual, "
                        + ", ".join(f"count(*) FILTER (WHERE predicted = '{p}') AS {p}, "
                                    f"round(100 * CAST(count(*) FILTER (WHERE predicted = '{p}') "
                                    f"AS DOUBLE) / count(*), 6) AS {p}_pct" for p in LABELS)
                        + " FROM ruled GROUP BY diagnostic_state",
    "classification_metrics": f"{CLASS_COUNTS} SELECT "
                              "round(CAST(sum(tp) AS DOUBLE) / (SELECT count(*) FROM ruled), 6) AS accuracy, "
                              "round(avg(f1), 6) AS macro_f1, "
                              "round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM s",
    "classification_report": f"{CLASS_COUNTS} SELECT label, round(prec, 6) AS precision, "
                             "round(rec, 6) AS recall, round(f1, 6) AS f1, support FROM s "
                             "UNION ALL SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), "
                             "round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM s "
                             "UNION ALL SELECT 'weighted avg', "
                             + ", ".join(f"round(sum({x} * support) / sum(support), 6)"
                                         for x in ("prec", "rec", "f1"))
                             + ", CAST(sum(support) AS BIGINT) FROM s",
    "speedup_efficiency": f"{READINGS}, t AS (SELECT {BUILDING} AS building, floor_number AS cores, "
                          f"avg(hvac_power_kw) AS time_s FROM readings GROUP BY {BUILDING}, floor_number), "
                          "b AS (SELECT *, first_value(time_s) OVER w AS bt, first_value(cores) OVER w "
                          "AS bc FROM t WINDOW w AS (PARTITION BY building ORDER BY cores)) "
                          "SELECT building, cores, round(time_s, 6) AS time_s, "
                          "round(bt / time_s, 6) AS speedup, "
                          "round(bt / time_s / (CAST(cores AS DOUBLE) / bc), 6) AS efficiency FROM b",
    "curve_crossover": _crossover(),
    "zone_index": f"{FULL} SELECT reading_id, building_zone_idx FROM vec",
    "label_index": f"{READINGS}, i AS ({frequency_index()}) SELECT reading_id, label FROM readings "
                   "JOIN i USING (diagnostic_state)",
    "global_median_impute": f"{TRAIN}, {medians('train', IMPUTED, 'm')} SELECT reading_id, "
                            + ", ".join(r(f"coalesce({c}, m_{c})", c) for c in IMPUTED)
                            + " FROM readings, m_t",
    "assembled_features": f"{FULL} SELECT reading_id, "
                          + ", ".join(r(f"CAST({c} AS DOUBLE)", c, RATIO_DIGITS)
                                      for c in VECTOR_FEATURES)
                          + " FROM vec",
    "scaled_features": f"{STATS} SELECT reading_id, {SCALED} FROM vec, stats",
    "feature_pipeline": f"{STATS} SELECT reading_id, CAST(CASE diagnostic_state WHEN 'normal' THEN 0 "
                        "WHEN 'ventilation_issue' THEN 1 ELSE 2 END AS DOUBLE) AS label, "
                        f"{SCALED}, {SIDE} FROM vec, stats",
    "onehot_zscore": f"{STATS} SELECT reading_id, active_zone, "
                     + ", ".join(r(f"({c} - a_{c}) / s_{c}", c) for c in MODEL_FEATURES)
                     + " FROM vec, stats",
    "rule_diagnosis": f"{RULED}, p AS (SELECT reading_id, predicted, CAST(CASE predicted "
                      "WHEN 'normal' THEN 0 WHEN 'ventilation_issue' THEN 1 ELSE 2 END AS INT) AS predicted_code, "
                      "CAST(CASE predicted WHEN 'normal' THEN 88 WHEN 'ventilation_issue' THEN 8 "
                      "ELSE 10 END AS DOUBLE) AS p_normal, "
                      "CAST(CASE predicted WHEN 'normal' THEN 7 WHEN 'ventilation_issue' THEN 84 "
                      "ELSE 12 END AS DOUBLE) AS p_ventilation, "
                      "CAST(CASE predicted WHEN 'normal' THEN 5 WHEN 'ventilation_issue' THEN 8 "
                      "ELSE 78 END AS DOUBLE) AS p_thermal FROM ruled) "
                      "SELECT *, greatest(p_normal, p_ventilation, p_thermal) AS confidence_pct FROM p",
    "top_contributions": _contributions(),
    "recommendations": f"{RULED} SELECT reading_id, predicted, {CODES} AS codes FROM ruled",
    "label_attributes": f"{RULED} SELECT reading_id, predicted, CASE predicted "
                        + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in LABEL_ATTRIBUTES.items())
                        + " END AS title, CASE predicted "
                        + " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in LABEL_ATTRIBUTES.items())
                        + " END AS colour FROM ruled",
    "stream_rule_diagnosis": f"{FILLED}, p AS (SELECT *, {RULE} AS predicted FROM feat) "
                             f"SELECT reading_id, {pick(IMPUTED)}, predicted, {CODES} AS codes FROM p",
    **{name: f"{READINGS} SELECT reading_id, diagnostic_state, "
             "diagnostic_state = 'ventilation_issue' AS is_ventilation, true AS is_known "
             f"FROM readings WHERE NOT ({BEFORE})"
       for name in ("model_logreg", "model_random_forest", "model_gbt_ovr")},
    "model_classes": f"{READINGS} SELECT model, reading_id, diagnostic_state AS predicted "
                     "FROM readings, (VALUES ('logreg'), ('forest'), ('boosted')) m(model) "
                     f"WHERE NOT ({BEFORE})",
    "model_report": f"{READINGS}, c AS (SELECT diagnostic_state AS label, count(*) AS support "
                    f"FROM readings WHERE NOT ({BEFORE}) GROUP BY 1), "
                    "a AS (SELECT * FROM c UNION ALL SELECT x, CAST(sum(support) AS BIGINT) "
                    "FROM c, (VALUES ('macro avg'), ('weighted avg')) v(x) GROUP BY x) "
                    "SELECT model, label, support, true AS is_good, "
                    "CASE label WHEN 'ventilation_issue' THEN CAST(1 AS DOUBLE) END AS ventilation_f1 "
                    "FROM a, (VALUES ('logreg'), ('forest')) m(model)",
    "tuning_results": "SELECT CAST(d AS DOUBLE) AS \"maxDepth\", CAST(t AS DOUBLE) AS \"numTrees\", "
                      "true AS is_good FROM (VALUES (7), (10)) x(d), (VALUES (20), (40)) y(t)",
    "top_importances": "SELECT feature, feature IN ('indoor_temp_c', 'co2_ppm', "
                       "'filter_pressure_pa', 'delta_temp_c') AS is_leading, true AS is_share, "
                       "CAST(1 AS DOUBLE) AS total FROM (VALUES "
                       + ", ".join(f"('{c}')" for c in VECTOR_FEATURES) + ") v(feature)",
    **{name: f"{READINGS} SELECT reading_id, diagnostic_state = 'ventilation_issue' "
             "AS is_ventilation, true AS is_largest, true AS is_confidence, true AS adds_up, "
             "CAST(6 AS INT) AS n_contributions, true AS has_advice FROM readings"
       for name in ("score_batch", "saved_model_scores", "stream_model_scores")},
    "scoring_vectors": f"{FULL}, ratios AS (SELECT reading_id AS id, {ratio_sql('clamp_epsilon')} "
                       "FROM readings) SELECT reading_id, "
                       + ", ".join(r(f"CAST({'ratios' if c in RATIOS else 'vec'}.{c} AS DOUBLE)", c,
                                     RATIO_DIGITS) for c in VECTOR_FEATURES)
                       + " FROM vec JOIN ratios ON id = reading_id",
    "json_roundtrip": f"{READINGS} SELECT diagnostic_state, count(*) AS n, "
                      "round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 2) "
                      "AS percentage FROM readings GROUP BY diagnostic_state",
    "coerce_wide_ids": f"{READINGS} SELECT reading_id + 3000000000 AS reading_id, "
                       "building_zone FROM readings",
    "zone_dimension_new_zones": f"{READINGS}, m AS (SELECT CASE WHEN reading_id % 3 = 0 THEN 'B01-Z05' "
                                "ELSE building_zone END AS z FROM readings), "
                                "a AS (SELECT DISTINCT split_part(z, '-', 1) AS building, zone "
                                "FROM m, (VALUES ('Z01'), ('Z02'), ('Z03'), ('Z04')) v(zone) UNION "
                                "SELECT split_part(z, '-', 1), split_part(z, '-', 2) FROM m) "
                                "SELECT building, zone, building || '-' || zone AS building_zone, "
                                "(SELECT count(*) FROM m WHERE z = building || '-' || zone) "
                                "AS n_readings FROM a",
    "stream_null_profile": f"{READINGS} SELECT time_bucket(INTERVAL '30 minutes', recorded_at) "
                           "AS window_start, building_zone, count(*) AS n, "
                           + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in IMPUTED)
                           + " FROM readings GROUP BY 1, 2",
}
