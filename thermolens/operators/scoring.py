"""Whole-table scoring with explanations and recommendations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolens.functions.labels import label_name
from thermolens.operators.features import add_physical_features, apply_defaults, coerce_numeric
from thermolens.operators.impute import PhysicalFeatures
from thermolens.operators.ml import LABEL
from thermolens.operators.rules import recommendations, rule_diagnosis
from thermolens.schema import IMPUTED, LABELS, PHYSICAL

# Importances used when no fitted model supplies its own.
DEFAULT_IMPORTANCES = {
    "co2_ppm": 0.22, "filter_pressure_pa": 0.18, "delta_temp_c": 0.15, "indoor_temp_c": 0.12,
    "air_flow_m3_h": 0.10, "pm25_indoor_outdoor_ratio": 0.08, "hvac_power_kw": 0.05,
    "filter_pressure_per_airflow": 0.04, "fan_speed_rpm": 0.03, "vibration_mm_s": 0.03,
}


def prepare_scoring_input(df: DataFrame) -> DataFrame:
    """Defaults for absent columns and ratios that are defined for any denominator."""
    filled = apply_defaults(df)
    return add_physical_features(coerce_numeric(filled, IMPUTED + PHYSICAL), "clamp_epsilon")


def serving_pipeline(features: PipelineModel) -> PipelineModel:
    """A fitted pipeline for new readings: ratios stay defined for any denominator, as they were
    prepared, and no label is asked for."""
    stages = [PhysicalFeatures(policy="clamp_epsilon") if isinstance(s, PhysicalFeatures) else s
              for s in features.stages
              if not (isinstance(s, StringIndexerModel) and s.getOutputCol() == LABEL)]
    return PipelineModel(stages=stages)


def score(df: DataFrame, features: PipelineModel, classifier: Model,
          labels: Sequence[str] = LABELS) -> DataFrame:
    """Adds predicted class, confidence and one probability per class (percent, one decimal)."""
    prepared = prepare_scoring_input(df)
    scored = classifier.transform(serving_pipeline(features).transform(prepared))
    p = vector_to_array(F.col("probability"))
    code = F.col("prediction").cast("int")
    out = scored.withColumns({
        "predicted": label_name(code, labels), "predicted_code": code,
        "confidence_pct": F.round(F.get(p, code) * 100, 1),
        "p_normal": F.round(p[0] * 100, 1), "p_ventilation": F.round(p[1] * 100, 1),
        "p_thermal": F.round(p[2] * 100, 1)})
    helper = {"raw_features", "features", "rawPrediction", "probability", "prediction"}
    return out.drop(*helper)


def diagnose(df: DataFrame, features: PipelineModel | None = None, classifier: Model | None = None,
             importances: Mapping[str, float] = DEFAULT_IMPORTANCES) -> DataFrame:
    """The full answer per reading: class, probabilities, contributions, recommendations.

    Without a fitted model the rules decide.
    """
    if features is not None and classifier is not None:
        scored = score(df, features, classifier)
    else:
        scored = rule_diagnosis(prepare_scoring_input(df))
    return recommendations(add_contributions(scored, importances))


def add_contributions(df: DataFrame, importances: Mapping[str, float] = DEFAULT_IMPORTANCES,
                      top: int = 6) -> DataFrame:
    """Adds ``contributions``: the features that matter most, with this row's values.

    Importances are global, so their order is known when the plan is built and each row only
    carries ``top`` entries; no per-row sort is needed. A feature the row lacks counts as 0.
    """
    ranked = sorted(importances.items(), key=lambda item: -item[1])[:top]
    entries = [F.struct(
        F.lit(name).alias("feature"),
        (F.round(F.col(name).try_cast("double"), 2) if name in df.columns else F.lit(0.0))
        .alias("value"),
        F.lit(round(weight * 100, 2)).alias("importance")) for name, weight in ranked]
    return df.withColumn("contributions", F.array(*entries))
