"""The registered queries: each takes (spark, folder) and returns a DataFrame.

All of them read whole tables. Floating-point results are rounded to six digits so that sums in
another order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolens.functions.labels import wall_clock
from thermolens.functions.numeric import rounded_half_away
from thermolens.operators import bitmaps, curves, evaluate, features, impute, ml, profile, rollup, rules
from thermolens.operators import scoring, split
from thermolens.operators.correlation import class_association, correlation_matrix
from thermolens.operators.forest import ForestModel
from thermolens.plans.jobs import feature_job, fit_train_apply_test, tuning_job
from thermolens.schema import (DELTAS, ENGINEERED, ID, IMPUTED, LABELS, MODEL_FEATURES, PHYSICAL,
                               RATIOS, RAW_SCHEMA, SCORING_SCHEMA, TARGET, TIME, VECTOR_FEATURES,
                               ZONE, ZONE_INDEX)
from thermolens.session import persisted, scratch_path, spread_rows
from thermolens.sources.fixture import EVENTS_SCHEMA, load_readings, readings_from_events
from thermolens.sources.guards import guard_report, require_columns
from thermolens.sources.tables import (coerce_schema, read_csv, read_days, read_first_available,
                                       read_table, write_csv, write_days, write_json)
from thermolens.streaming import jobs as streams

CUTOFF = "2024-01-24"
FIRST_ROWS = 5_000
FIRST_DAY = "2024-01-02"
# Quotients of the derived readings end within eight decimals or never: no rounding ties.
RATIO_DIGITS = 8
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def query_named(name: str) -> Callable[[Query], Query]:
    """For queries whose name is taken by the operator they call."""
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column."""
    return df.select(*[
        rounded_half_away(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`") for f in df.schema])


def _sides(train: DataFrame, test: DataFrame, *columns: str) -> DataFrame:
    train, test = (d.select(*columns, F.lit(name).alias("split"))
                   for d, name in ((train, "train"), (test, "test")))
    return train.unionByName(test)


def _train(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_by_cutoff(load_readings(spark, folder), CUTOFF)[0]


def _ruled(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_diagnosis(load_readings(spark, folder))


# --- scans, sinks and guards ---------------------------------------------------------------------

@query
def scan_parquet(spark, folder):
    return rounded(read_table(spark, f"{folder}/lineitem.parquet"))


@query
def scan_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "readings-csv") + ".csv"
    write_csv(load_readings(spark, folder).withColumn(TIME, F.col(TIME).cast("string")), path)
    return rounded(features.parse_time(read_csv(spark, path, RAW_SCHEMA)))


@query
def scan_csv_inferred(spark, folder):
    """A CSV file whose types are found by reading it, at the second of two paths."""
    path = scratch_path(spark, "readings-csv") + ".csv"
    write_csv(load_readings(spark, folder).withColumn(TIME, F.col(TIME).cast("string")), path)
    found = read_first_available(spark, [f"{path}.missing.csv", path], None)
    require_columns(found, RAW_SCHEMA.fieldNames())
    kinds = dict(found.dtypes)
    numbers = [c for c in RAW_SCHEMA.fieldNames() if kinds[c] in ("int", "bigint", "double")]
    return rounded(found.select(*[
        F.col(c).cast(RAW_SCHEMA[c].dataType).alias(c) if c in numbers else F.col(c)
        for c in RAW_SCHEMA.fieldNames() if c != TIME], F.lit(len(numbers)).alias("n_numbers")))


@query
def daily_feature_table(spark, folder):
    """Features by day: all days are written, one of them twice, and those before the cutoff read."""
    path = scratch_path(spark, "daily")
    made = features.add_physical_features(load_readings(spark, folder)).select(
        ID, TIME, ZONE, *ENGINEERED)
    write_days(made, path)
    write_days(made.filter(F.to_date(TIME) == F.lit(FIRST_DAY).cast("date")), path)
    return rounded(read_days(spark, path, end=CUTOFF), RATIO_DIGITS)


@query
def first_n_rows(spark, folder):
    readings = load_readings(spark, folder)
    return split.first_rows(readings, FIRST_ROWS).select(ID, TIME, ZONE)


@query
def feature_metadata(spark, folder):
    """Position, role and fitted scale of every entry of the feature vector."""
    with persisted(spread_rows(_train(spark, folder))) as train:
        model = ml.feature_pipeline(include_label=False).fit(train)
    scale = [float(s) for s in model.stages[-1].std]
    rows = [(i, name, name in IMPUTED, name in ENGINEERED, scale[i])
            for i, name in enumerate(VECTOR_FEATURES)]
    return rounded(spark.createDataFrame(
        rows, "position int, feature string, imputed boolean, engineered boolean, scale double"))


@query_named("coerce_schema")
def coerce_to_schema(spark, folder):
    text = load_readings(spark, folder).select(
        ID, *[F.col(c).cast("string").alias(c) for c in SCORING_SCHEMA.fieldNames()
              if c not in ENGINEERED])
    text = text.withColumn("fan_speed_rpm", F.when(
        F.col(ID) % 50 == 0, "n/a").otherwise(F.col("fan_speed_rpm")))
    schema = T.StructType([T.StructField(ID, T.LongType()), *SCORING_SCHEMA.fields])
    return rounded(coerce_schema(text, schema))


@query
def coerce_wide_ids(spark, folder):
    """Ids beyond 32 bits, as text and with a fraction."""
    wide = (F.col(ID) + 3_000_000_000).cast("string")
    text = load_readings(spark, folder).select(
        F.when(F.col(ID) % 2 == 0, wide).otherwise(F.concat(wide, F.lit(".0"))).alias(ID), ZONE)
    return coerce_schema(text, T.StructType([T.StructField(ID, T.LongType()),
                                             T.StructField(ZONE, T.StringType())]))


@query_named("guard_report")
def guard_counts(spark, folder):
    return guard_report(_train(spark, folder), ZONE, IMPUTED)


# --- projections ---------------------------------------------------------------------------------

@query
def coerce_numeric(spark, folder):
    rest = F.col(ID) % 10
    text = (F.when(rest == 0, "bad").when(rest == 1, "NaN").when(rest == 2, "Infinity")
            .when(rest == 3, "-Infinity").otherwise(F.col("tvoc_ppb").cast("string")))
    readings = load_readings(spark, folder).withColumn("tvoc_ppb", text)
    return rounded(features.coerce_numeric(readings).select(ID, *IMPUTED, *PHYSICAL))


@query
def drop_columns(spark, folder):
    return rounded(load_readings(spark, folder).drop(ID, "firmware_version"))


@query
def rename_columns(spark, folder):
    names = {"building": "Building", "zones": "Zones", "sensors": "Sensors",
             "normal_pct": "Normal", "ventilation_pct": "Ventilation", "thermal_pct": "Thermal",
             "risk": "Risk"}
    return rounded(features.rename_columns(building_rollup(spark, folder), names))


@query
def delta_features(spark, folder):
    return rounded(features.add_deltas(load_readings(spark, folder)).select(ID, *DELTAS))


def _ratios(spark, folder, policy):
    return rounded(features.add_ratios(load_readings(spark, folder), policy).select(ID, *RATIOS),
                   RATIO_DIGITS)


@query
def ratio_features(spark, folder):
    return _ratios(spark, folder, "null")


@query
def ratio_features_add_epsilon(spark, folder):
    return _ratios(spark, folder, "add_epsilon")


@query
def ratio_features_clamp_epsilon(spark, folder):
    return _ratios(spark, folder, "clamp_epsilon")


@query
def enrich_idempotent(spark, folder):
    partial = load_readings(spark, folder).drop("hvac_power_kw").withColumn(
        "delta_temp_c", F.col("floor_number").cast("double"))
    enriched = features.enrich(features.enrich(partial))
    return rounded(enriched.select(ID, *[c for c in ENGINEERED if c in enriched.columns]),
                   RATIO_DIGITS)


@query
def parse_timestamp(spark, folder):
    text = F.when(F.col(ID) % 17 == 0, "not a time").otherwise(F.col(TIME).cast("string"))
    parsed = load_readings(spark, folder).select(ID, text.alias("recorded_text")).select(
        ID, wall_clock("recorded_text").alias(TIME))
    return parsed.select(ID, TIME, F.col(TIME).isNotNull().alias("is_valid"))


@query
def convert_timezone(spark, folder):
    readings = load_readings(spark, folder)
    return features.convert_timezone(readings, "Asia/Ho_Chi_Minh", into="local_at").select(
        ID, "local_at")


@query
def label_indicators(spark, folder):
    return features.add_label_indicators(load_readings(spark, folder)).select(
        ID, *[f"state_{label}" for label in LABELS])


@query
def label_encode(spark, folder):
    return features.encode_label(load_readings(spark, folder)).select(ID, TARGET, "label_code")


@query
def apply_defaults(spark, folder):
    absent = ("tvoc_ppb", "fan_speed_rpm", "maintenance_days", "vibration_mm_s")
    filled = features.apply_defaults(load_readings(spark, folder).drop(*absent))
    return filled.select(ID, *absent, "occupancy_count", "window_open_pct")


@query
def sensor_bands(spark, folder):
    return features.add_bands(load_readings(spark, folder)).select(
        ID, *[f"{c}_band" for c in features.BANDS])


@query
def range_violations(spark, folder):
    return features.range_violations(load_readings(spark, folder))


@query
def parse_zone(spark, folder):
    return features.parse_zone(load_readings(spark, folder)).select(
        ID, "building", "zone", "zone_floor")


@query
def feature_projection(spark, folder):
    enriched = features.add_physical_features(load_readings(spark, folder))
    return rounded(features.project_features(enriched), RATIO_DIGITS)


# --- splits, samples and ranks -------------------------------------------------------------------

@query
def split_by_cutoff(spark, folder):
    return _sides(*split.split_by_cutoff(load_readings(spark, folder), CUTOFF), ID)


@query
def split_by_rank(spark, folder):
    return _sides(*split.split_by_rank(load_readings(spark, folder), 0.8), ID)


@query
def stratified_split(spark, folder):
    return split.add_stratified_split(load_readings(spark, folder), 0.8).select(
        ID, TARGET, "split")


@query
def hash_sample(spark, folder):
    return split.hash_sample(load_readings(spark, folder), 0.15).select(ID)


@query
def hash_split(spark, folder):
    return _sides(*split.hash_split(load_readings(spark, folder), 0.8), ID)


# --- joins and imputation ------------------------------------------------------------------------

@query
def group_median_impute(spark, folder):
    model = impute.GroupMedianImputer().fit(_train(spark, folder))
    return rounded(model.transform(load_readings(spark, folder)).select(ID, *IMPUTED))


@query_named("fit_train_apply_test")
def fit_train_apply_test_rows(spark, folder):
    fitted = fit_train_apply_test(load_readings(spark, folder), CUTOFF)
    return rounded(_sides(fitted.train, fitted.test, ID, *IMPUTED, *ENGINEERED), RATIO_DIGITS)


@query
def zone_dimension(spark, folder):
    return rollup.zone_dimension(load_readings(spark, folder))


@query
def zone_dimension_new_zones(spark, folder):
    """A third of the readings moved to a zone that no list knows."""
    moved = F.when(F.col(ID) % 3 == 0, "B01-Z05").otherwise(F.col(ZONE))
    return rollup.zone_dimension(load_readings(spark, folder).withColumn(ZONE, moved))


# --- aggregates ----------------------------------------------------------------------------------

@query
def row_count_limit(spark, folder):
    return profile.row_count_limit(load_readings(spark, folder), 8_000)


@query
def label_distribution(spark, folder):
    return profile.label_distribution(load_readings(spark, folder))


@query
def null_profile(spark, folder):
    return profile.null_profile(load_readings(spark, folder))


@query
def null_profile_by_zone(spark, folder):
    return profile.null_profile_by(load_readings(spark, folder))


@query
def label_by_firmware(spark, folder):
    return profile.pair_counts(load_readings(spark, folder))


@query
def global_median(spark, folder):
    return rounded(impute.global_medians(load_readings(spark, folder)))


@query
def group_median(spark, folder):
    return rounded(impute.group_medians(load_readings(spark, folder)))


@query
def order_price_median(spark, folder):
    """The same grouped median on another table: nearly every price is a distinct value."""
    orders = read_table(spark, f"{folder}/orders.parquet")
    return rounded(impute.group_medians(orders, "o_orderstatus", ["o_totalprice"]))


@query
def group_observed_count(spark, folder):
    return profile.observed_counts(load_readings(spark, folder))


@query
def zone_summary(spark, folder):
    return rounded(profile.group_summary(load_readings(spark, folder)))


@query
def label_index_counts(spark, folder):
    readings = load_readings(spark, folder).select(TARGET)
    indexed = ml.frequency_indexer().fit(readings).transform(readings)
    return indexed.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query
def column_average(spark, folder):
    return rounded(profile.average(load_readings(spark, folder), "indoor_temp_c"))


def _train_features(spark, folder):
    return features.add_physical_features(_train(spark, folder))


@query_named("correlation_matrix")
def correlation_matrix_long(spark, folder):
    return rounded(correlation_matrix(_train_features(spark, folder)))


@query
def feature_class_association(spark, folder):
    return rounded(class_association(_train_features(spark, folder)))


@query
def split_time_range(spark, folder):
    readings = load_readings(spark, folder)
    side = F.when(split.cutoff_condition(readings, CUTOFF), "train").otherwise("test")
    return profile.time_range_by(readings, side)


@query
def building_rollup(spark, folder):
    return rounded(rollup.building_rollup(load_readings(spark, folder), 65.0, 60.0))


@query
def building_rollup_merged(spark, folder):
    """The same from three batches of days, whose bitmaps and counts are stored and added up."""
    readings, path = load_readings(spark, folder), scratch_path(spark, "buildings")
    book = bitmaps.CodeBook(spark, f"{path}/codes")
    for i in range(3):
        part = readings.filter(F.pmod(F.dayofyear(TIME), F.lit(3)) == i)
        bitmaps.building_state(part, book).write.parquet(f"{path}/state/batch={i}")
    stored = spark.read.parquet(f"{path}/state").drop("batch")
    return rounded(bitmaps.rollup_of(bitmaps.merge_states([stored]), 65.0, 60.0))


@query
def floor_issue_rate(spark, folder):
    return rounded(rollup.floor_issue_rate(load_readings(spark, folder)))


@query
def confusion_matrix(spark, folder):
    return rounded(evaluate.confusion_matrix(_ruled(spark, folder)))


@query
def classification_metrics(spark, folder):
    return rounded(evaluate.classification_metrics(_ruled(spark, folder)))


@query
def classification_report(spark, folder):
    return rounded(evaluate.classification_report(_ruled(spark, folder)))


@query
def speedup_efficiency(spark, folder):
    """A timing series per building: mean power per floor stands for the time per core count."""
    series = profile.group_summary(
        features.parse_zone(load_readings(spark, folder)).withColumn(
            "_key", F.struct("building", "floor_number")), "_key")
    timing = series.select("_key.building", F.col("_key.floor_number").alias("cores"),
                           F.col("avg_power").alias("time_s"))
    return rounded(curves.speedup_efficiency(timing, "building"))


@query
def curve_crossover(spark, folder):
    """Where mean indoor temperature passes the outdoor one, along maintenance age."""
    parsed = features.parse_zone(load_readings(spark, folder))
    timing = parsed.groupBy("building", F.col("maintenance_days").alias("size")).agg(
        F.avg("indoor_temp_c").alias("first_time"), F.avg("outdoor_temp_c").alias("second_time"))
    return rounded(curves.curve_crossover(timing, "building"))


# --- feature vectors and models ------------------------------------------------------------------

@query
def zone_index(spark, folder):
    train = _train(spark, folder)
    ml.check_categories(train, ZONE)
    return ml.zone_indexer().fit(train).transform(load_readings(spark, folder)).select(
        ID, ZONE_INDEX)


@query
def label_index(spark, folder):
    readings = load_readings(spark, folder)
    ml.check_categories(readings, TARGET)
    return ml.frequency_indexer().fit(readings).transform(readings).select(ID, "label")


@query
def global_median_impute(spark, folder):
    readings = load_readings(spark, folder)
    return rounded(impute.impute_global(readings, fitted_on=_train(spark, folder))
                   .select(ID, *IMPUTED))


def _vectors(spark, folder, stages: Sequence) -> DataFrame:
    readings = load_readings(spark, folder, spread=True)
    with persisted(split.split_by_cutoff(readings, CUTOFF)[0]) as train:
        model = Pipeline(stages=list(stages)).fit(train)
    return model.transform(readings)


@query
def assembled_features(spark, folder):
    made = _vectors(spark, folder, [*ml.cleaning_stages(), *ml.vector_stages()[:2]])
    return rounded(ml.spread(made.select(ID, "raw_features"), "raw_features", VECTOR_FEATURES),
                   RATIO_DIGITS)


@query
def scaled_features(spark, folder):
    made = _vectors(spark, folder, [*ml.cleaning_stages(), *ml.vector_stages()])
    return rounded(ml.spread(made.select(ID, "features"), "features", VECTOR_FEATURES))


def _fitted(spark, folder, pipeline: Pipeline | None = None):
    """A pipeline fitted on the training side, and both sides."""
    train, test = split.split_by_cutoff(load_readings(spark, folder), CUTOFF)
    with persisted(spread_rows(train)) as kept:
        model = (pipeline or ml.feature_pipeline()).fit(kept)
    return model, train, test


def _vectors_of(pipeline, df: DataFrame) -> DataFrame:
    return pipeline.transform(spread_rows(df)).select("label", "features")


@query
def feature_pipeline(spark, folder):
    model, train, test = _fitted(spark, folder)
    made = _sides(*(model.transform(d) for d in (train, test)), ID, "label", "features")
    return rounded(ml.spread(made, "features", VECTOR_FEATURES))


@query
def onehot_zscore(spark, folder):
    with persisted(spread_rows(_train(spark, folder))) as train:
        model = ml.onehot_pipeline(include_label=False).fit(train)
    made = model.transform(spread_rows(load_readings(spark, folder)))
    zones = F.array(*[F.lit(z) for z in ml.fitted_zones(model)])
    hot = F.array_position(ml.vector_to_array("zone_onehot"), F.lit(1.0))
    named = made.select(ID, "zscores", F.get(zones, (hot - 1).cast("int")).alias("active_zone"))
    return rounded(ml.spread(named, "zscores", MODEL_FEATURES))


def _forest(data: DataFrame):
    return ml.forest(50, 14).fit(data)


def _logreg(data: DataFrame):
    return ml.logistic_regression().fit(data)


def _boosted(data: DataFrame):
    return ml.boosted_trees(rounds=100).fit(data)


def _fit_model(pipeline, train: DataFrame, fit: Callable):
    with persisted(_vectors_of(pipeline, train)) as data:
        return fit(data)


def _predicted(spark, folder, fit: Callable, pipeline: Pipeline | None = None) -> DataFrame:
    """Test rows with what a model fitted on the training rows says. Ventilation faults are
    separable in the derived readings, so a model that works finds exactly those."""
    features_, train, test = _fitted(spark, folder, pipeline)
    model = _fit_model(features_, train, fit)
    return ml.predictions(model.transform(features_.transform(test)))


def _told(scored: DataFrame) -> DataFrame:
    return scored.select(ID, TARGET, (F.col("predicted") == LABELS[1]).alias("is_ventilation"),
                         F.col("predicted").isin(*LABELS).alias("is_known"))


@query
def model_logreg(spark, folder):
    return _told(_predicted(spark, folder, _logreg, ml.onehot_pipeline()))


@query
def model_random_forest(spark, folder):
    return _told(_predicted(spark, folder, _forest))


@query
def model_gbt_ovr(spark, folder):
    return _told(_predicted(spark, folder, _boosted))


@query
def model_classes(spark, folder):
    """What three fitted models say of every test row, where all classes can be told apart: thermal
    faults are ten degrees warmer here."""
    warmer = F.when(F.col(TARGET) == LABELS[2], 10.0).otherwise(0.0)
    readings = load_readings(spark, folder).withColumn(
        "indoor_temp_c", F.col("indoor_temp_c") + warmer)
    train, test = split.split_by_cutoff(readings, CUTOFF)
    told = []
    with persisted(spread_rows(train)) as kept:
        for pipeline, fits in ((ml.onehot_pipeline(), {"logreg": _logreg}),
                               (ml.feature_pipeline(), {"forest": _forest, "boosted": _boosted})):
            vectors = pipeline.fit(kept)
            with persisted(vectors.transform(kept).select("label", "features")) as data:
                for name, fit in fits.items():
                    scored = ml.predictions(fit(data).transform(vectors.transform(test)))
                    told.append(scored.select(F.lit(name).alias("model"), ID, "predicted"))
    return told[0].unionByName(told[1]).unionByName(told[2])


@query
def model_report(spark, folder):
    """Quality of two fitted models on the test rows, per class and averaged."""
    reports = []
    for name, fit, pipeline in (("logreg", _logreg, ml.onehot_pipeline()),
                                ("forest", _forest, None)):
        scored = _predicted(spark, folder, fit, pipeline)
        reports.append(evaluate.classification_report(scored).select(
            F.lit(name).alias("model"), "label", "support", (F.col("f1") > 0.8).alias("is_good"),
            F.when(F.col("label") == LABELS[1], F.col("f1")).alias("ventilation_f1")))
    return reports[0].unionByName(reports[1])


@query
def tuning_results(spark, folder):
    pipeline, train, test = _fitted(spark, folder)
    return tuning_job(train, test, pipeline).table.select(
        "maxDepth", "numTrees", F.col("cv_f1").between(0.8, 1.0).alias("is_good"))


@query
def top_importances(spark, folder):
    """All importances; the four readings that decide the derived classes lead them."""
    pipeline, train, _ = _fitted(spark, folder)
    model = _fit_model(pipeline, train, _forest)
    table = ml.importance_table(model, VECTOR_FEATURES, train)
    leading = ml.top_importances(table, 4).withColumn("is_leading", F.lit(True))
    total = table.agg(F.sum("importance").alias("total"))
    return table.join(F.broadcast(leading), ["feature", "importance"], "left").join(
        F.broadcast(total)).select(
        "feature", F.coalesce("is_leading", F.lit(False)).alias("is_leading"),
        F.col("importance").between(0, 1).alias("is_share"),
        F.round("total", 9).alias("total"))


# --- scoring -------------------------------------------------------------------------------------

def _weights(forest) -> dict[str, float]:
    return dict(zip(VECTOR_FEATURES, (float(v) for v in forest.featureImportances.toArray())))


def _answers(answer: DataFrame) -> DataFrame:
    """What must hold of any scored row, and the class that is certain."""
    shares = F.array("p_normal", "p_ventilation", "p_thermal")
    top = F.array_max(shares)
    return answer.select(
        ID, (F.col("predicted") == LABELS[1]).alias("is_ventilation"),
        (F.get(shares, F.col("predicted_code")) == top).alias("is_largest"),
        (F.col("confidence_pct") == top).alias("is_confidence"),
        (F.abs(F.col("p_normal") + F.col("p_ventilation") + F.col("p_thermal") - 100) < 0.21)
        .alias("adds_up"),
        F.size("contributions").alias("n_contributions"),
        (F.size("recommendations") > 0).alias("has_advice"))


@query
def score_batch(spark, folder):
    """New readings have no label, so none is given."""
    pipeline, train, _ = _fitted(spark, folder)
    forest = _fit_model(pipeline, train, _forest)
    given = load_readings(spark, folder).withColumn(TARGET, F.lit(None).cast("string"))
    return _answers(scoring.diagnose(given, pipeline, forest, _weights(forest)))


@query
def scoring_vectors(spark, folder):
    """The 24 inputs a model is given when it scores, ratios over small air flows included."""
    pipeline, _, _ = _fitted(spark, folder)
    given = load_readings(spark, folder).withColumn(TARGET, F.lit(None).cast("string"))
    made = scoring.serving_pipeline(pipeline).transform(scoring.prepare_scoring_input(given))
    return rounded(ml.spread(made.select(ID, "raw_features"), "raw_features", VECTOR_FEATURES),
                   RATIO_DIGITS)


@query
def saved_model_scores(spark, folder):
    """Pipeline and model are saved, loaded and used."""
    pipeline, train, _ = _fitted(spark, folder)
    path = scratch_path(spark, "models")
    pipeline.write().save(f"{path}/pipeline")
    _fit_model(pipeline, train, _forest).write().save(f"{path}/forest")
    loaded = PipelineModel.load(f"{path}/pipeline")
    forest = ForestModel.load(f"{path}/forest")
    return _answers(scoring.diagnose(load_readings(spark, folder), loaded, forest,
                                     _weights(forest)))


@query
def feature_job_outputs(spark, folder):
    """Both sides as the feature job writes them, from a raw CSV file."""
    raw, out = scratch_path(spark, "raw") + ".csv", scratch_path(spark, "features")
    write_csv(load_readings(spark, folder).withColumn(TIME, F.col(TIME).cast("string")), raw)
    feature_job(spark, raw, out, CUTOFF)
    sides = [spark.read.parquet(f"{out}/{name}_features.parquet") for name in ("train", "test")]
    return rounded(_sides(*sides, ID, *IMPUTED, *ENGINEERED), RATIO_DIGITS)


@query
def json_roundtrip(spark, folder):
    path = scratch_path(spark, "labels") + ".json"
    write_json(profile.label_distribution(load_readings(spark, folder)), path)
    return read_table(spark, path, T.StructType.fromDDL(
        "diagnostic_state string, n bigint, percentage double"))


@query
def rule_diagnosis(spark, folder):
    return _ruled(spark, folder).select(
        ID, "predicted", "predicted_code", "confidence_pct", "p_normal", "p_ventilation",
        "p_thermal")


@query
def top_contributions(spark, folder):
    prepared = scoring.prepare_scoring_input(load_readings(spark, folder))
    made = scoring.add_contributions(prepared)
    return rounded(made.select(ID, F.posexplode("contributions").alias("position", "c")).select(
        ID, (F.col("position") + 1).alias("position"), "c.feature", "c.value", "c.importance"))


@query
def recommendations(spark, folder):
    made = rules.recommendations(_ruled(spark, folder))
    return made.select(ID, "predicted", F.array_join("recommendations", ",").alias("codes"))


@query
def label_attributes(spark, folder):
    made = rules.add_label_attributes(_ruled(spark, folder))
    return made.select(ID, "predicted", "title", "colour")


# --- streaming -----------------------------------------------------------------------------------

def _reading_stream(spark, folder):
    # A pattern, because a stream takes a folder or a pattern but not one plain file.
    events = streams.read_stream(spark, f"{folder}/events.parque[t]", EVENTS_SCHEMA)
    return readings_from_events(spark, events)


@query
def stream_rule_diagnosis(spark, folder):
    medians = impute.GroupMedianImputer().fit(_train(spark, folder))
    out, log = scratch_path(spark, "diagnoses"), scratch_path(spark, "diagnoses-log")
    result = streams.diagnose_stream(_reading_stream(spark, folder), medians)
    streams.run_to_files(result.select(
        ID, *IMPUTED, "predicted", F.array_join("recommendations", ",").alias("codes")), out, log)
    return rounded(spark.read.parquet(out))


@query
def stream_model_scores(spark, folder):
    """The stream is scored by the model that scores batches."""
    pipeline, train, _ = _fitted(spark, folder)
    forest = _fit_model(pipeline, train, _forest)
    out, log = scratch_path(spark, "scores"), scratch_path(spark, "scores-log")
    result = streams.score_stream(_reading_stream(spark, folder), pipeline, forest)
    streams.run_to_files(_answers(result), out, log)
    return spark.read.parquet(out)


@query
def stream_null_profile(spark, folder):
    out, log = scratch_path(spark, "null-profile"), scratch_path(spark, "null-profile-log")
    result = streams.null_profile_stream(_reading_stream(spark, folder))
    streams.run_updates_to_files(result, out, log)
    return streams.latest_updates(spark, out, ["window_start", ZONE])
