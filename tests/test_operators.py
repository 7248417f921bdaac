"""Operators against small fixtures: cleaning, splits, metrics, rules, curves, guards."""

import io
from contextlib import redirect_stdout

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from thermolens.functions.labels import wall_clock
from thermolens.functions.numeric import band, rounded_half_away
from thermolens.operators import curves, evaluate, features, rules, scoring, split
from thermolens.operators.correlation import class_association, correlation_matrix, correlations
from thermolens.schema import (ENGINEERED, ID, IMPUTED, MODEL_FEATURES, RAW_SCHEMA,
                               SCORING_DEFAULTS, SCORING_SCHEMA, VECTOR_FEATURES)
from thermolens.sources.guards import check_training_input, require_columns
from thermolens.sources.tables import rows_to_table


def test_schema_groups():
    assert len(RAW_SCHEMA) == 24 and len(MODEL_FEATURES) == 23 and len(VECTOR_FEATURES) == 24
    assert len(SCORING_SCHEMA) == 25 and len(SCORING_DEFAULTS) == 19


def test_cleaning_of_bad_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), ("-Infinity",), (None,),
                                ("",), ("1e400",)], "tvoc_ppb string")
    values = [r[0] for r in features.coerce_numeric(df).collect()]
    assert values == [1.5] + [None] * 7


@pytest.mark.parametrize("policy,expected", [
    ("null", [2.0, None, None, None]), ("add_epsilon", [20 / 10.00001, 20 / 1e-5, 20 / -0.99999, None]),
    ("clamp_epsilon", [2.0, 20 / 1e-5, 20 / 1e-5, None])])
def test_ratio_policies(spark, policy, expected):
    df = spark.createDataFrame([(20.0, d, 1.0, 1.0, 1.0) for d in (10.0, 0.0, -1.0, None)],
                               "pm25_ug_m3 double, outdoor_pm25_ug_m3 double, "
                               "filter_pressure_pa double, air_flow_m3_h double, hvac_power_kw double")
    got = [r.pm25_indoor_outdoor_ratio for r in features.add_ratios(df, policy).collect()]
    assert got == pytest.approx(expected)
    with pytest.raises(ValueError):
        features.add_ratios(df, "other")


def test_enrich_keeps_what_is_there(readings):
    once = features.enrich(readings)
    assert set(ENGINEERED) <= set(once.columns)
    assert features.enrich(once).exceptAll(once).isEmpty()
    marked = readings.withColumn("delta_temp_c", F.lit(99.0))
    assert features.enrich(marked).select("delta_temp_c").distinct().collect()[0][0] == 99.0


def test_bands_leave_nulls_alone(spark):
    df = spark.createDataFrame([(999.0,), (1000.0,), (1400.0,), (None,)], "co2_ppm double")
    made = df.select(band("co2_ppm", *features.BANDS["co2_ppm"]).alias("b")).collect()
    assert [r.b for r in made] == ["safe", "warning", "danger", None]


def test_raw_time_format_is_parsed(spark):
    df = spark.createDataFrame([("2025-10-01T00:30",), ("2025-13-01T00:00",)], "t string")
    first, second = (r[0] for r in df.select(wall_clock("t")).collect())
    assert str(first) == "2025-10-01 00:30:00" and second is None


def test_rounding(spark):
    df = spark.createDataFrame([(1.5,), (-1.5,), (-0.0,), (2e300,), (None,)], "x double")
    assert [r[0] for r in df.select(rounded_half_away("x", 0)).collect()] == [2, -2, 0, 2e300, None]


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_splits_are_disjoint_and_complete(readings, limit):
    ids = readings.select(ID)
    for train, test in (split.split_by_rank(readings, 0.8, limit=limit),
                        split.hash_split(readings, 0.8),
                        split.split_by_cutoff(readings, "2024-01-24", check=True)):
        both = train.select(ID).unionByName(test.select(ID))
        assert both.exceptAll(ids).isEmpty() and ids.exceptAll(both).isEmpty()
    assert split.split_by_rank(readings, 0.8, limit=limit)[0].count() == 800
    assert split.first_rows(readings, 37, limit=limit).count() == 37
    assert split.first_rows(readings, 10 ** 9, limit=limit).count() == 1000
    assert split.first_rows(readings, 0, limit=limit).count() == 0
    counts = {(r.diagnostic_state, r.split): r["count"] for r in
              split.add_stratified_split(readings, 0.8, limit=limit)
              .groupBy("diagnostic_state", "split").count().collect()}
    totals = {r.diagnostic_state: r["count"]
              for r in readings.groupBy("diagnostic_state").count().collect()}
    assert {k: int(v * 0.8) for k, v in totals.items()} == {
        k[0]: v for k, v in counts.items() if k[1] == "train"}


def test_sampling_does_not_depend_on_partitions(readings):
    a = {r[0] for r in split.hash_sample(readings).select(ID).collect()}
    b = {r[0] for r in split.hash_sample(readings.repartition(7)).select(ID).collect()}
    assert a == b and 100 < len(a) < 200
    assert 50 < split.bernoulli_sample(readings).count() < 250
    assert sum(d.count() for d in split.random_split(readings)) == 1000


def test_split_guards(readings):
    with pytest.raises(ValueError, match="empty"):
        split.split_by_cutoff(readings, "2030-01-01", check=True)
    with pytest.raises(ValueError):
        split.split_by_cutoff(readings, "not a date")
    bad = readings.withColumn("recorded_at", F.lit("never"))
    with pytest.raises(ValueError, match="invalid"):
        split.split_by_cutoff(bad, "2024-01-24", check=True)
    with pytest.raises(Exception, match="recorded_at contains null values"):
        split.split_by_rank(readings.withColumn("recorded_at", F.lit(None).cast("timestamp_ntz")))


def test_guards(readings):
    require_columns(readings, IMPUTED)
    with pytest.raises(ValueError, match="Missing required columns: a, b"):
        require_columns(readings, ["b", "a", ID])
    check_training_input(readings, "building_zone", IMPUTED)
    with pytest.raises(ValueError, match="empty"):
        check_training_input(readings.filter("false"), "building_zone", IMPUTED)


def test_correlation_is_symmetric_and_has_every_class(spark, readings):
    rows = correlation_matrix(features.add_physical_features(readings)).collect()
    matrix = {(r.a, r.b): r.r for r in rows}
    names = {a for a, _ in matrix}
    assert len(matrix) == 64 and "state_thermal_issue" in names
    assert all(matrix[a, b] == matrix[b, a] for a in names for b in names)
    assert all(matrix[a, a] == pytest.approx(1) for a in names)
    only_normal = features.add_physical_features(readings.filter("diagnostic_state = 'normal'"))
    flat = {(r.a, r.b): r.r for r in correlation_matrix(only_normal).collect()}
    assert flat["state_thermal_issue", "delta_temp_c"] == 0.0
    ranked = [r.max_abs_class_correlation
              for r in class_association(features.add_physical_features(readings)).collect()]
    assert ranked == sorted(ranked, reverse=True) and len(ranked) == 5


def test_metrics_by_hand(spark):
    rows = ([("normal", "normal")] * 6 + [("normal", "thermal_issue")] * 2
            + [("ventilation_issue", "ventilation_issue")] * 3 + [("thermal_issue", "normal")])
    df = spark.createDataFrame(rows, "diagnostic_state string, predicted string")
    m = evaluate.classification_metrics(df).first()
    f1 = {"normal": 12 / 15, "ventilation_issue": 1.0, "thermal_issue": 0.0}
    assert m.accuracy == pytest.approx(9 / 12)
    assert m.macro_f1 == pytest.approx(sum(f1.values()) / 3)
    assert m.weighted_f1 == pytest.approx((8 * f1["normal"] + 3) / 12)
    report = {r.label: r for r in evaluate.classification_report(df).collect()}
    assert report["thermal_issue"].precision == 0 and report["thermal_issue"].support == 1
    assert report["macro avg"].support == 12
    cells = {r.actual: r for r in evaluate.confusion_matrix(df).collect()}
    assert cells["normal"].thermal_issue == 2 and cells["normal"].thermal_issue_pct == 25.0


# The four scoring presets and the class each must get.
PRESETS = [
    ("normal", dict(building_zone="B01-Z01", co2_ppm=510, filter_pressure_pa=92.12, indoor_temp_c=22.14,
                    outdoor_temp_c=10.9, pm25_ug_m3=9.69, outdoor_pm25_ug_m3=12, air_flow_m3_h=478.6,
                    hvac_power_kw=4.0)),
    ("ventilation_issue", dict(building_zone="B01-Z02", co2_ppm=1250, filter_pressure_pa=144.94,
                               indoor_temp_c=20.44, outdoor_temp_c=11.87, pm25_ug_m3=42.31,
                               outdoor_pm25_ug_m3=15, air_flow_m3_h=234.34, hvac_power_kw=3.4)),
    ("thermal_issue", dict(building_zone="B01-Z01", co2_ppm=568, filter_pressure_pa=124.64,
                           indoor_temp_c=26.8, outdoor_temp_c=10.41, pm25_ug_m3=2.72,
                           outdoor_pm25_ug_m3=8, air_flow_m3_h=536.57, hvac_power_kw=5.67)),
    ("normal", dict(building_zone="B03-Z01", co2_ppm=820, filter_pressure_pa=110, indoor_temp_c=23.5,
                    outdoor_temp_c=28.5, pm25_ug_m3=18, outdoor_pm25_ug_m3=25, air_flow_m3_h=2850,
                    hvac_power_kw=12.5)),
]


def test_presets_get_their_class_and_advice(spark):
    rows = [{"maintenance_days": "25.0", **given} for _, given in PRESETS]
    typed = rows_to_table(spark, rows, SCORING_SCHEMA)
    assert typed.schema == SCORING_SCHEMA and typed.first().maintenance_days == 25
    given = typed.select(*PRESETS[0][1], "maintenance_days")
    made = scoring.diagnose(given).collect()
    assert [r.predicted for r in made] == [label for label, _ in PRESETS]
    assert made[1].recommendations == ["clogged_filter", "high_co2", "low_air_flow"]
    assert made[2].recommendations == ["large_temperature_gap"]
    assert made[0].recommendations == ["all_good", "keep_schedule"]
    assert (made[1].p_normal, made[1].p_ventilation, made[1].confidence_pct) == (8.0, 84.0, 84.0)
    assert [c.feature for c in made[0].contributions] == [
        "co2_ppm", "filter_pressure_pa", "delta_temp_c", "indoor_temp_c", "air_flow_m3_h",
        "pm25_indoor_outdoor_ratio"]
    assert made[0].contributions[2].value == pytest.approx(11.24)
    assert made[0].tvoc_ppb == SCORING_DEFAULTS["tvoc_ppb"]


def test_whole_numbers_are_bounded_by_their_own_type(spark):
    from pyspark.sql import types as T

    from thermolens.sources.tables import coerce_schema

    rows = [("3000000000",), ("25.0",), ("-7.9",), ("9223372036854775808",), ("x",), (None,), ("NaN",)]
    text = spark.createDataFrame(rows, "v string").selectExpr("v AS a", "v AS b", "v AS c")
    made = coerce_schema(text, T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()),
        T.StructField("c", T.ByteType())]))
    assert [tuple(r) for r in made.collect()] == [
        (3_000_000_000, None, None), (25, 25, 25), (-7, -7, -7)] + [(None, None, None)] * 4


def test_defaults_do_not_fill_nulls(spark):
    df = spark.createDataFrame([(None,)], "co2_ppm double")
    filled = features.apply_defaults(df).first()
    assert filled.co2_ppm is None and filled.maintenance_days == 30


def test_speedup_and_crossover(spark):
    timing = spark.createDataFrame([("s", 2, 328.4), ("s", 4, 178.6), ("s", 8, 104.2)],
                                   "name string, cores int, time_s double")
    made = curves.speedup_efficiency(timing, "name").orderBy("cores").collect()
    assert [round(r.speedup, 2) for r in made] == [1.0, 1.84, 3.15]
    assert [round(r.efficiency, 2) for r in made] == [1.0, 0.92, 0.79]
    sizes = spark.createDataFrame([("s", 200, 10.6, 42.8), ("s", 500, 32.7, 68.4), ("s", 1000, 88.3, 105.2),
                                   ("s", 2100, 306.1, 178.6)],
                                  "name string, size int, first_time double, second_time double")
    crossed = curves.curve_crossover(sizes, "name").collect()
    assert len(crossed) == 1 and 1100 < crossed[0].crossover_size < 1200


def test_rows_without_time_or_id_are_an_error(spark, readings):
    from thermolens.operators import split

    gaps = readings.withColumn("recorded_at", F.when(F.col("reading_id") % 7 > 0, F.col("recorded_at")))
    with pytest.raises(Exception, match="invalid time stamps"):
        split.split_by_cutoff(gaps, "2024-01-24")[1].collect()
    no_ids = readings.withColumn("reading_id", F.when(F.col("reading_id") % 7 > 0, F.col("reading_id")))
    for made in (split.hash_sample(no_ids), *split.hash_split(no_ids)):
        with pytest.raises(Exception, match="contains null values"):
            made.collect()
    ids = spark.range(200_000).withColumnRenamed("id", "reading_id")
    for share in (0.57, 0.69, 0.29):
        last = split.hash_sample(ids, share).agg(F.max(split.hash_bucket("reading_id", 10_000)))
        assert last.first()[0] == round(share * 10_000) - 1


def test_scoring_keeps_clamped_ratios_and_needs_no_label(spark, readings):
    from thermolens.operators import ml

    pipeline = ml.feature_pipeline().fit(readings)
    still = readings.limit(20).withColumns({"air_flow_m3_h": F.lit(0.0),
                                            "diagnostic_state": F.lit(None).cast("string")})
    made = scoring.serving_pipeline(pipeline).transform(scoring.prepare_scoring_input(still))
    for r in made.collect():
        assert r.filter_pressure_per_airflow == pytest.approx(r.filter_pressure_pa / 1e-5)


def test_correlation_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, 4.0), (4.0, 5.0, 1.0),
                                (float("nan"), 5.0, 2.0)], "a double, b double, c double")
    found = {(r.a, r.b): r.r for r in correlations(df, ["a"], ["b", "c", "a"]).collect()}
    assert found == {("a", "b"): 0.0, ("a", "c"): pytest.approx(-1.0), ("a", "a"): pytest.approx(1)}
    assert {r.r for r in correlations(df.limit(0), ["a", "b"], ["a", "b"]).collect()} <= {0.0}


def test_many_columns_are_correlated_in_one_scan(spark, tmp_path):
    r = np.random.default_rng(4)
    x = r.normal(size=(700, 200)) @ r.normal(size=(200, 200)) + 1e6
    x[r.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.0
    names = [f"c{i}" for i in range(200)]
    path = str(tmp_path / "wide.parquet")
    spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(5).write.parquet(path)
    wide = spark.read.parquet(path)
    matrix = correlations(wide, names, names)
    plan = io.StringIO()
    with redirect_stdout(plan):
        matrix.explain()
    assert plan.getvalue().count("FileScan") == 1
    found = {(row.a, row.b): row.r for row in matrix.collect()}
    expected = pd.DataFrame(x, columns=names).corr().fillna(0.0)
    assert len(found) == 40_000 and all(
        abs(found[a, b] - expected.loc[a, b]) < 1e-9 for a in names for b in names)
