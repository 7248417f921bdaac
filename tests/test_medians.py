"""Grouped medians and rank boundaries, on ordinary and on hostile distributions."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from thermolens.operators import order_stats, sketches
from thermolens.operators.features import add_physical_features, coerce_numeric
from thermolens.operators.impute import (GroupMedianImputer, GroupMedianModel, global_medians,
                                         group_medians, impute_global)
from thermolens.operators.order_stats import exact_medians, rank_boundary, select_ranks
from thermolens.schema import IMPUTED, PHYSICAL
from thermolens.session import keep, lookup_join

SCHEMA = ("building_zone string, occupancy_count double, tvoc_ppb double, vibration_mm_s double, "
          "window_open_pct double, indoor_temp_c double, outdoor_temp_c double, "
          "indoor_humidity_pct double, outdoor_humidity_pct double, pm25_ug_m3 double, "
          "outdoor_pm25_ug_m3 double, filter_pressure_pa double, air_flow_m3_h double, "
          "hvac_power_kw double, diagnostic_state string")


# Readings whose engineered columns are 5, -10, 2, 2 and 0.05.
STEADY = dict(
    indoor_temp_c=25.0, outdoor_temp_c=20.0, indoor_humidity_pct=50.0, outdoor_humidity_pct=60.0,
    pm25_ug_m3=20.0, outdoor_pm25_ug_m3=10.0, filter_pressure_pa=200.0, air_flow_m3_h=100.0,
    hvac_power_kw=5.0, diagnostic_state="normal")
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def frame(spark, levels, **changed):
    """One reading per (zone, level of all four sensors) pair."""
    rows = []
    for zone, level in levels:
        sensors = dict.fromkeys(IMPUTED, level)
        rows.append([{"building_zone": zone, **STEADY, **sensors, **changed}[n] for n in NAMES])
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def train(spark):
    return frame(spark, [("A", 1.0), ("B", 20.0), ("A", None), ("A", 3.0), ("B", None), ("B", 10.0)])


def transformed(model, df):
    return add_physical_features(coerce_numeric(model.transform(df), PHYSICAL))


def test_medians_come_from_training_rows_and_unseen_zones_use_the_global_one(spark, train):
    model = GroupMedianImputer().fit(train)
    future = frame(spark, [(z, None) for z in "ABC"], diagnostic_state="thermal_issue")
    rows = transformed(model, future).orderBy("building_zone").collect()
    assert [r.occupancy_count for r in rows] == [2, 15, 6.5]
    assert {r.diagnostic_state for r in rows} == {"thermal_issue"}
    assert {r.delta_temp_c for r in rows} == {5}
    assert {r.delta_humidity_pct for r in rows} == {-10}
    assert {r.pm25_indoor_outdoor_ratio for r in rows} == {2}
    assert {r.filter_pressure_per_airflow for r in rows} == {2}
    assert {r.hvac_kw_per_airflow for r in rows} == {0.05}


def test_zero_denominators_become_missing(spark, train):
    model = GroupMedianImputer().fit(train)
    out = transformed(model, frame(
        spark, [("A", None)], outdoor_pm25_ug_m3=0.0, air_flow_m3_h=0.0)).first()
    assert out.pm25_indoor_outdoor_ratio is None
    assert out.filter_pressure_per_airflow is None
    assert out.hvac_kw_per_airflow is None
    assert all(out[c] is not None for c in IMPUTED)


@pytest.mark.parametrize("limit", [1, 1_000_000])
def test_zone_without_values_uses_the_global_median(spark, train, limit):
    gaps = train.withColumn("tvoc_ppb", F.when(F.col("building_zone") != "B", F.col("tvoc_ppb")))
    model = GroupMedianImputer(rankedValues=limit).fit(gaps)
    assert model.transform(frame(spark, [("B", None)])).first().tvoc_ppb == 2


def test_bad_input_is_refused(spark, train):
    with pytest.raises(ValueError, match="empty"):
        GroupMedianImputer().fit(train.filter("false"))
    with pytest.raises(ValueError, match="null"):
        GroupMedianImputer().fit(frame(spark, [(None, 1.0)]))
    with pytest.raises(ValueError, match="tvoc_ppb"):
        GroupMedianImputer().fit(train.withColumn("tvoc_ppb", F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="Missing required columns: tvoc_ppb"):
        GroupMedianImputer().fit(train.drop("tvoc_ppb"))
    with pytest.raises(RuntimeError):
        GroupMedianModel().transform(train)
    model = GroupMedianImputer().fit(train)
    with pytest.raises(Exception, match="contains null values"):
        model.transform(frame(spark, [(None, 1.0)])).collect()


def test_model_survives_saving(spark, train, tmp_path):
    model = GroupMedianImputer().fit(train)
    model.write().overwrite().save(f"{tmp_path}/model")
    loaded = GroupMedianModel.load(f"{tmp_path}/model")
    assert loaded.columns == list(IMPUTED) and loaded.fallback == model.fallback
    future = frame(spark, [(z, None) for z in "ABC"])
    assert (sorted(loaded.transform(future).collect()) == sorted(model.transform(future).collect()))


def hostile(seed):
    """One group with most rows; ties, outliers, clusters, tiny gaps and single values."""
    rng = random.Random(seed)
    rows = [("hot", rng.choice([1e300, -1e300, 0.0, 5.0, rng.random(), rng.gauss(100, 1e-9)]))
            for _ in range(3000)]
    rows += [("cluster", 1.0 + i * 1e-12) for i in range(300)]
    rows += [("cluster", 1e6 + i * 1e-6) for i in range(300)]
    rows += [("tied", 7.0)] * 500 + [("single", -3.0)]
    rows += [(f"g{i % 11}", rng.lognormvariate(0, 20)) for i in range(700)]
    return pd.DataFrame(rows, columns=["k", "value"])


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limit", [1_000_000, 50, 1])
def test_exact_medians_whatever_the_distribution(spark, seed, limit):
    data = hostile(seed)
    obs = spark.createDataFrame(data).repartition(4)
    picked = select_ranks(obs, ["k"], "value", order_stats.middle_ranks, limit).collect()
    for r in picked:
        values = sorted(data[data.k == r.k].value)
        n = len(values)
        assert (r.n, r.low, r.high) == (n, values[(n - 1) // 2], values[n // 2])
        assert r.below == sum(v < r.low for v in values)
    assert {r.k for r in picked} == set(data.k)


@pytest.mark.parametrize("values", [
    [10.0 ** (i % 400 - 200) * (1 + i / 7000) for i in range(6000)],
    [float(i) for i in range(5999)] + [1e308], [float(i % 2 * 1e6 + i) for i in range(6000)]])
def test_few_narrowings_on_any_distribution(spark, monkeypatch, values):
    """Log-spaced values, an outlier, and a gap: two or three narrowings, not one per digit."""
    calls, narrow = [], order_stats._narrow
    monkeypatch.setattr(order_stats, "_narrow", lambda *a: calls.append(1) or narrow(*a))
    obs = spark.createDataFrame([("one", v) for v in values], "k string, value double")
    found = select_ranks(obs, ["k"], "value", order_stats.middle_ranks, 50).first()
    ordered = sorted(values)
    assert (found.low, found.high) == (ordered[(len(values) - 1) // 2], ordered[len(values) // 2])
    assert len(calls) <= 3


def test_the_middle_of_two_values_does_not_depend_on_size_or_overflow(spark):
    pairs = [("a", 0.1), ("a", 0.7), ("b", -1.7e308), ("b", 1.7e308), ("c", 5.3), ("c", 5.3)]
    df = spark.createDataFrame(pairs, "k string, v double")
    for limit in (1, 1_000_000):
        found = {r.k: r["median"] for r in exact_medians(df, ["k"], ["v"], limit).collect()}
        assert found == {"a": pytest.approx(0.4), "b": 0.0, "c": 5.3}


def test_narrowed_and_direct_medians_agree(readings):
    clean = readings.select("building_zone", *IMPUTED)
    direct = {(r[0], r[1]): r[2] for r in exact_medians(clean, ["building_zone"], IMPUTED).collect()}
    narrow = {(r[0], r[1]): r[2] for r in
              exact_medians(clean, ["building_zone"], IMPUTED, limit=5).collect()}
    assert direct == pytest.approx(narrow) and len(direct) >= 56
    wide = group_medians(readings, limit=5).orderBy("building_zone").collect()
    assert wide == group_medians(readings).orderBy("building_zone").collect()
    assert global_medians(readings, limit=5).first() == global_medians(readings).first()


def test_approximate_medians_are_observed_values(readings):
    exact = global_medians(readings).first()
    near = global_medians(readings, method="approx").first()
    assert near.vibration_mm_s == pytest.approx(exact.vibration_mm_s, abs=1)
    assert group_medians(readings, method="approx").count() == group_medians(readings).count()


def test_global_imputation_leaves_no_gap(readings):
    filled = impute_global(readings)
    assert filled.filter(" or ".join(f"{c} is null" for c in IMPUTED)).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 1_000_000])
def test_rank_boundary_cuts_ties_by_the_next_column(spark, limit):
    rng = random.Random(5)
    rows = [("hot", 7, i) for i in range(400)] + [("hot", rng.randrange(20), 400 + i)
                                                    for i in range(400)]
    rows += [("cold", rng.randrange(-5, 5), -i) for i in range(37)] + [("one", 1, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, a bigint, b bigint")
    known, groups = rank_boundary(df, ["a", "b"], lambda n: F.floor(n * 0.8), ["k"], limit)
    assert groups == 3
    found = {r.k: (r._b0, r._b1) for r in known.table.collect()}
    for k in ("hot", "cold"):
        ordered = sorted((a, b) for key, a, b in rows if key == k)
        assert found[k] == ordered[int(len(ordered) * 0.8) - 1]
    assert "one" not in found


def test_lookup_join_splits_hot_keys(spark, monkeypatch):
    import thermolens.session as session
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(session, "HOT_SHARE", 3)
    df = spark.createDataFrame([("hot", i) for i in range(90)] + [("a", 1), ("b", 2), ("new", 3)],
                               "k string, v int")
    table = spark.createDataFrame([("hot", 1.0, 90), ("a", 2.0, 1), ("b", 3.0, 1)],
                                  "k string, m double, n bigint")
    joined = lookup_join(df, table, ["k"], 3, weight="n").toPandas()
    assert len(joined) == 93
    assert joined.set_index("k").m.groupby(level=0).max().to_dict()["hot"] == 1.0
    assert joined[joined.k == "new"].m.isna().all()
    inner = lookup_join(df, table, ["k"], 3, how="inner", weight="n")
    assert inner.count() == 92


def test_large_fitted_tables_go_to_storage(spark, monkeypatch):
    kept = keep(spark.range(5), 1_000_000)
    assert kept.rows is None and kept.table.count() == 5
    assert spark.sparkContext.getCheckpointDir()


def days_of(spark, seed, n):
    r = random.Random(seed)
    return spark.createDataFrame(
        [(r.choice(("hot", "hot", "hot", "b", "c")), r.gauss(0, 5) if r.random() > 0.1 else None,
          float(r.randrange(3))) for _ in range(n)] + [("none", None, 1.0)],
        "zone string, v double, w double")


def expected_medians(df):
    rows = df.toPandas()
    by = {(z, c): m for c in ("v", "w") for z, m in rows.groupby("zone")[c].median().items()
          if m == m}
    return by | {(None, c): rows[c].median() for c in ("v", "w")}


def test_sketches_of_a_new_day_are_merged_and_medians_stay_exact(spark, tmp_path):
    columns, path = ["v", "w"], str(tmp_path / "state")
    first, second = days_of(spark, 1, 20_000), days_of(spark, 2, 9_000).withColumn(
        "v", F.col("v") + 3)
    long, state = sketches.exact_medians_by(first, "zone", columns)
    assert {(r.zone, r.column): r["median"] for r in long.collect()} == expected_medians(first)
    state.write.parquet(path)  # the next day, another session
    merged = sketches.merge_sketches(
        [spark.read.parquet(path), sketches.sketch_columns(second, "zone", columns)], "zone",
        columns)
    both = first.unionByName(second)
    long, _ = sketches.exact_medians_by(both, "zone", columns, merged)
    assert {(r.zone, r.column): r["median"] for r in long.collect()} == expected_medians(both)


def test_a_margin_that_is_too_small_or_a_group_too_large_is_noticed(spark, monkeypatch):
    df = days_of(spark, 3, 5_000)
    counted = []
    by_counting = sketches.medians_with_total
    monkeypatch.setattr(sketches, "medians_with_total",
                        lambda *x: counted.append(1) or by_counting(*x))
    for margin, limit, ways in ((0.0125, 200_000, 0), (0.0125, 10, 1), (-0.2, 200_000, 2)):
        monkeypatch.setattr(sketches, "MARGIN", margin)
        long, _ = sketches.exact_medians_by(df, "zone", ["v", "w"], limit=limit)
        assert {(r.zone, r.column): r["median"] for r in long.collect()} == expected_medians(df)
        assert len(counted) == ways
    none = df.limit(0)
    assert sketches.exact_medians_by(none, "zone", ["v", "w"])[0].count() == 0
