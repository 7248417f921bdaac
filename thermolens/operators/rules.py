"""Rule-based diagnosis, recommendations and label presentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolens.functions.labels import label_code
from thermolens.functions.numeric import guarded_ratio
from thermolens.schema import LABELS, RATIO_INPUTS

NORMAL, VENTILATION, THERMAL = LABELS

# Limits of the rule classifier.
VENTILATION_LIMITS = {"co2_ppm": 1100, "filter_pressure_pa": 135, "pm25_indoor_outdoor_ratio": 2.5}
THERMAL_LIMITS = {"temperature_gap": 14, "indoor_temp_c": 28.5, "busy_power_kw": 6.0, "busy_temp_c": 26.0}
# Class probabilities reported with a rule diagnosis, in label order.
RULE_PROBABILITIES = {
    "normal": (0.88, 0.07, 0.05),
    "ventilation_issue": (0.08, 0.84, 0.08),
    "thermal_issue": (0.10, 0.12, 0.78),
}
# Limits that trigger a recommendation.
RECOMMENDATION_LIMITS = {"filter_pressure_pa": 120, "co2_ppm": 1000, "air_flow_m3_h": 300,
                         "indoor_temp_c": 27, "temperature_gap": 12, "hvac_power_kw": 6}

# Colour and icon of each class on displays.
LABEL_ATTRIBUTES = {
    "normal": ("Normal", "#22C55E", "\U0001F7E2"),
    "ventilation_issue": ("Ventilation issue", "#EF4444", "\U0001F534"),
    "thermal_issue": ("Thermal issue", "#F59E0B", "\U0001F7E1"),
}


def _gap() -> Column:
    return F.abs(F.col("indoor_temp_c") - F.col("outdoor_temp_c"))


def rule_label() -> Column:
    """The first rule that fires; a null input does not fire its own test."""
    ratio = guarded_ratio(*RATIO_INPUTS["pm25_indoor_outdoor_ratio"], "clamp_epsilon")
    v, t = VENTILATION_LIMITS, THERMAL_LIMITS
    ventilation = ((F.col("co2_ppm") > v["co2_ppm"])
                   | (F.col("filter_pressure_pa") > v["filter_pressure_pa"])
                   | (ratio > v["pm25_indoor_outdoor_ratio"]))
    busy = (F.col("hvac_power_kw") > t["busy_power_kw"]) & (F.col("indoor_temp_c") > t["busy_temp_c"])
    thermal = (_gap() > t["temperature_gap"]) | (F.col("indoor_temp_c") > t["indoor_temp_c"]) | busy
    return F.when(ventilation, VENTILATION).when(thermal, THERMAL).otherwise(NORMAL)


def probability_of(label: Column, index: int) -> Column:
    chosen = None
    for name, shares in RULE_PROBABILITIES.items():
        chosen = (F.when(label == name, shares[index]) if chosen is None
                  else chosen.when(label == name, shares[index]))
    return chosen


def rule_diagnosis(df: DataFrame) -> DataFrame:
    """Adds ``predicted``, its code, confidence and the three probabilities, in percent."""
    labelled = df.withColumn("predicted", rule_label())
    p = [F.round(probability_of(F.col("predicted"), i) * 100, 1) for i in range(len(LABELS))]
    return (labelled.withColumns({
        "predicted_code": label_code("predicted"),
        "p_normal": p[0], "p_ventilation": p[1], "p_thermal": p[2]})
        .withColumn("confidence_pct", F.greatest("p_normal", "p_ventilation", "p_thermal")))


def recommendations(df: DataFrame, predicted: str = "predicted") -> DataFrame:
    """Adds ``recommendations``: message codes, most specific first."""
    limit = RECOMMENDATION_LIMITS

    def fired(*tests: tuple[Column, str], otherwise: str) -> Column:
        codes = F.array_compact(F.array(*[F.when(test, code) for test, code in tests]))
        return F.when(F.size(codes) == 0, F.array(F.lit(otherwise))).otherwise(codes)
    ventilation = fired(
        (F.col("filter_pressure_pa") > limit["filter_pressure_pa"], "clogged_filter"),
        (F.col("co2_ppm") > limit["co2_ppm"], "high_co2"),
        (F.col("air_flow_m3_h") < limit["air_flow_m3_h"], "low_air_flow"),
        otherwise="ventilation_check")
    thermal = fired(
        (F.col("indoor_temp_c") > limit["indoor_temp_c"], "overheated_room"),
        (_gap() > limit["temperature_gap"], "large_temperature_gap"),
        (F.col("hvac_power_kw") > limit["hvac_power_kw"], "peak_hvac_load"),
        otherwise="thermal_check")
    normal = F.array(F.lit("all_good"), F.lit("keep_schedule"))
    label = F.col(predicted)
    return df.withColumn("recommendations", F.when(label == VENTILATION, ventilation)
                         .when(label == THERMAL, thermal).otherwise(normal))


def add_label_attributes(df: DataFrame, label: str = "predicted") -> DataFrame:
    """Adds title, colour and icon of the class from a three-row dimension."""
    spark = df.sparkSession
    rows = [(name, *attributes) for name, attributes in LABEL_ATTRIBUTES.items()]
    dim = spark.createDataFrame(rows, f"{label} string, title string, colour string, icon string")
    return df.join(F.broadcast(dim), label, "left")
