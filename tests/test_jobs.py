"""Sources, sinks, pipelines, models and whole jobs."""

import io
import json
import re
from contextlib import redirect_stdout
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from thermolens.operators import bitmaps, ml
from thermolens.operators.profile import label_distribution
from thermolens.operators.rollup import building_rollup
from thermolens.operators.scoring import diagnose
from thermolens.plans import jobs
from thermolens.schema import (ID, LABELS, MODEL_FEATURES, RAW_SCHEMA, TIME, VECTOR_FEATURES, ZONE)
from thermolens.session import session_report, shared_folder, spread_rows
from thermolens.sources import tables

CUTOFF = "2024-01-24"


@pytest.fixture(scope="module")
def sides(readings):
    from thermolens.operators.split import split_by_cutoff
    return split_by_cutoff(readings, CUTOFF)


@pytest.fixture(scope="module")
def pipeline(sides):
    return ml.feature_pipeline().fit(sides[0])


@pytest.fixture(scope="module")
def vectors(sides, pipeline):
    return spread_rows(pipeline.transform(sides[0]).select("label", "features")).cache()


def test_csv_with_and_without_schema(spark, readings, tmp_path):
    path = f"{tmp_path}/raw.csv"
    tables.write_csv(readings.withColumn(TIME, F.date_format(TIME, "yyyy-MM-dd'T'HH:mm")), path)
    typed = tables.read_csv(spark, path)
    assert typed.schema == RAW_SCHEMA and typed.count() == 1000
    inferred = tables.read_csv(spark, path, schema=None)
    assert inferred.columns == typed.columns and inferred.count() == 1000
    assert tables.format_of(path) == "csv" and tables.format_of("/a/folder") == "parquet"
    (tmp_path / "bad.csv").write_text(",".join(RAW_SCHEMA.names) + "\n" + "x," * 23 + "normal\n")
    bad = tables.read_csv(spark, f"{tmp_path}/bad.csv").first()
    assert bad.reading_id is None and bad.co2_ppm is None and bad.diagnostic_state == "normal"
    kept = tables.read_csv(spark, f"{tmp_path}/bad.csv", StructType(
        [*RAW_SCHEMA, StructField(tables.CORRUPT, StringType())])).first()
    assert kept[tables.CORRUPT].endswith(",normal")


def test_first_available_source(spark, readings, tmp_path):
    tables.write_parquet(readings, f"{tmp_path}/there")
    found = tables.load_readings_table(spark, [f"{tmp_path}/missing.csv", f"{tmp_path}/there"],
                                       partitions=3)
    assert found.count() == 1000 and "delta_temp_c" in found.columns
    with pytest.raises(FileNotFoundError, match="missing"):
        tables.read_first_available(spark, [f"{tmp_path}/missing"])


def test_fixed_decimals(spark, tmp_path):
    tables.write_csv(spark.createDataFrame([("a", 1 / 3)], "n string, r double"),
                     f"{tmp_path}/m.csv", decimals=5)
    assert tables.read_csv(spark, f"{tmp_path}/m.csv", "n string, r string").first().r == "0.33333"


def test_feature_job(spark, readings, tmp_path):
    raw = f"{tmp_path}/raw.csv"
    tables.write_csv(readings.withColumn(TIME, F.date_format(TIME, "yyyy-MM-dd'T'HH:mm")), raw)
    ranked = jobs.feature_job(spark, raw, f"{tmp_path}/out", CUTOFF).collect()
    train = spark.read.parquet(f"{tmp_path}/out/train_features.parquet")
    test = spark.read.parquet(f"{tmp_path}/out/test_features.parquet")
    assert train.count() + test.count() == 1000 and len(ranked) == 5
    matrix = tables.read_csv(spark, f"{tmp_path}/out/feature_correlation_matrix.csv", None)
    assert matrix.count() == 64
    again = jobs.feature_job(spark, (f"{tmp_path}/out/train_features.parquet",
                                     f"{tmp_path}/out/test_features.parquet"), f"{tmp_path}/two")
    assert [r.feature for r in again.collect()] == [r.feature for r in ranked]
    with pytest.raises(ValueError, match="empty"):
        jobs.feature_job(spark, raw, f"{tmp_path}/three", "2031-01-01")


def test_pipeline_job_saves_model_and_metadata(spark, sides, tmp_path):
    model = jobs.pipeline_job(spark, sides[0], f"{tmp_path}")
    loaded = PipelineModel.load(f"{tmp_path}/model")
    a = model.transform(sides[1]).select(ID, "features").orderBy(ID).collect()
    b = loaded.transform(sides[1]).select(ID, "features").orderBy(ID).collect()
    assert a == b and len(a[0].features) == 24
    text = next(Path(f"{tmp_path}/metadata").glob("part-*.json")).read_text()
    metadata = json.loads(text)
    assert metadata["feature_names"] == list(VECTOR_FEATURES)
    assert metadata["feature_vector_dimension"] == 24 and metadata["labels"] == list(LABELS)


def test_unseen_zone_and_label(spark, sides, pipeline):
    new = sides[1].limit(3).withColumn(ZONE, F.lit("B09-Z09"))
    rows = pipeline.transform(new).select("raw_features").collect()
    zones = sides[0].select(ZONE).distinct().count()
    assert {r.raw_features[23] for r in rows} == {float(zones)}
    with pytest.raises(Exception, match="[Uu]nseen label"):
        pipeline.transform(new.withColumn("diagnostic_state", F.lit("other"))).select("label").collect()
    onehot = ml.onehot_pipeline(include_label=False).fit(sides[0])
    made = onehot.transform(new).select("zone_onehot").first().zone_onehot
    assert made.numNonzeros() == 0 and made.size == zones


def test_category_guard(readings, monkeypatch):
    ml.check_categories(readings, ZONE)
    monkeypatch.setattr(ml.check_categories, "__defaults__", (3,))
    for indexer in (ml.zone_indexer(), ml.frequency_indexer(ZONE)):
        with pytest.raises(ValueError, match="categories"):
            indexer.fit(readings)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="categories"):
        ml.check_categories(readings, ID, limit=10)


def test_forest_scores_three_classes_and_repeats(sides, pipeline, vectors):
    first, second = (ml.forest(8, 5).fit(vectors) for _ in range(2))
    assert first.numClasses == 3
    weights = dict(zip(VECTOR_FEATURES, first.featureImportances.toArray().tolist()))
    assert sum(weights.values()) == pytest.approx(1)
    given = sides[1].drop("tvoc_ppb", "diagnostic_state").withColumn(
        "diagnostic_state", F.lit("normal"))
    answers = [diagnose(given, pipeline, m, weights).orderBy(ID).collect() for m in (first, second)]
    assert answers[0] == answers[1]
    for r in answers[0]:
        p = (r.p_normal, r.p_ventilation, r.p_thermal)
        assert sum(p) == pytest.approx(100, abs=0.2) and r.confidence_pct == pytest.approx(max(p))
        assert r.predicted == LABELS[r.predicted_code] and len(r.contributions) == 6
    table = ml.top_importances(ml.importance_table(first, VECTOR_FEATURES, vectors), 15)
    ranked = [r.importance for r in table.collect()]
    assert len(ranked) == 15 and ranked == sorted(ranked, reverse=True)
    with pytest.raises(ValueError):
        ml.importance_table(first, VECTOR_FEATURES[:3], vectors)


def test_onehot_importances_merge_to_their_column(spark):
    names = ml.expanded_names(MODEL_FEATURES[:1], ZONE, ["A", "B"])
    table = spark.createDataFrame(list(zip(names, (0.5, 0.2, 0.3))),
                                  "feature string, importance double")
    merged = {r.feature: r.importance for r in ml.merge_onehot(table).collect()}
    assert merged == {"floor_number": 0.5, ZONE: 0.5}


def test_boosted_trees_know_three_classes(sides, pipeline, vectors):
    model = ml.boosted_trees(rounds=2, depth=3).fit(vectors)
    scored = ml.predictions(model.transform(pipeline.transform(sides[1])))
    assert {r.predicted for r in scored.select("predicted").distinct().collect()} == set(LABELS)


def test_tuning_job(sides, pipeline, tmp_path, monkeypatch):
    grid = {"maxDepth": (2, 5), "numTrees": (2,)}
    original = ml.tune_forest
    monkeypatch.setattr(jobs, "tune_forest", lambda df: original(df, grid, folds=2))
    tuned = jobs.tuning_job(*sides, pipeline, f"{tmp_path}/best")
    table = tuned.table.orderBy("maxDepth").collect()
    assert [r.maxDepth for r in table] == [2, 5] and all(0 < r.cv_f1 <= 1 for r in table)
    assert tuned.metrics.first().accuracy > 0.8 and tuned.importances.count() == 15
    assert Path(f"{tmp_path}/best/metadata").exists()


def test_spark_imputer_stage(readings):
    filled = ml.global_median_imputer().fit(readings).transform(readings)
    assert filled.filter("tvoc_ppb is null or occupancy_count is null").count() == 0


def test_session_report_and_spread(spark, readings):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = spread_rows(readings).withColumn("_p", F.spark_partition_id())
    assert spread.select("_p").distinct().count() == width and spread.count() == 1000
    report = session_report(spark)
    assert report["adaptive"] == "true" and report["checkpoint_dir"] == shared_folder(spark)


def test_label_distribution_adds_up(readings):
    rows = label_distribution(readings).collect()
    assert sum(r.n for r in rows) == 1000
    assert sum(r.percentage for r in rows) == pytest.approx(100, abs=0.05)


def test_a_repeated_day_replaces_itself_and_other_days_are_not_read(spark, readings, tmp_path):
    path = str(tmp_path / "days")
    tables.write_days(readings, path)
    day = F.to_date("recorded_at") == F.lit("2024-01-05").cast("date")
    before = sorted(map(tuple, spark.read.parquet(path).drop("day").collect()))
    for _ in range(2):
        tables.write_days(readings.filter(day), path)
    assert sorted(map(tuple, spark.read.parquet(path).drop("day").collect())) == before
    late = tables.read_days(spark, path, "2024-01-20 12:00:00", "2024-01-22")
    assert late.columns == readings.columns and late.count() == readings.filter(
        "recorded_at >= '2024-01-20 12:00:00' and recorded_at < '2024-01-22'").count() > 0
    plan = io.StringIO()
    with redirect_stdout(plan):
        late.explain("formatted")
    assert re.search(r"PartitionFilters: \[.*day", plan.getvalue())
    none = readings.limit(2).withColumn("recorded_at", F.lit(None).cast("timestamp_ntz"))
    tables.write_days(none, path)
    assert tables.read_days(spark, path).count() == 1002
    assert tables.read_days(spark, path, end="2025-01-01").count() == 1000


def test_distinct_counts_of_batches_add_up(spark, readings, tmp_path):
    book = bitmaps.CodeBook(spark, str(tmp_path / "codes"))
    parts = [readings.filter(F.pmod("reading_id", F.lit(4)) == i) for i in range(4)]
    states = []
    for i, part in enumerate(parts):  # each is stored, as on another day
        bitmaps.building_state(part, book).write.parquet(str(tmp_path / f"state{i}"))
        states.append(spark.read.parquet(str(tmp_path / f"state{i}")))
        seen = readings.filter(F.pmod("reading_id", F.lit(4)) <= i)
        told = bitmaps.rollup_of(bitmaps.merge_states(states)).orderBy("building").collect()
        assert told == building_rollup(seen).orderBy("building").select(told[0].__fields__).collect()
    codes = book.table().collect()
    assert len({r.code for r in codes}) == len({(r.kind, r.value) for r in codes}) == len(codes)
    assert bitmaps.rollup_of(bitmaps.building_state(readings.limit(0), book)).count() == 0


def test_raw_columns_are_dealt_out_not_derived_ones(spark, folder):
    from thermolens.plans.queries import QUERIES
    from thermolens.sources.fixture import load_readings

    plain, spread = (load_readings(spark, folder, spread=s) for s in (False, True))
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, spread.collect()), key=str)
    plan = io.StringIO()
    with redirect_stdout(plan):
        QUERIES["assembled_features"](spark, folder).explain("formatted")
    dealt = re.findall(r"\) Exchange\nInput \[(\d+)\].*\nArguments: RoundRobin", plan.getvalue())
    assert dealt and max(map(int, dealt)) <= 6
