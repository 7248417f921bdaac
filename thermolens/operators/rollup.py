"""Building, floor and zone roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermolens.functions.labels import building, indicator, zone_part
from thermolens.schema import LABELS, TARGET, ZONE

NORMAL, VENTILATION, THERMAL = LABELS


def _share(label: str) -> Column:
    return F.avg(indicator(TARGET, label)) * 100


def building_rollup(df: DataFrame, low_from: float = 75.0, medium_from: float = 72.0) -> DataFrame:
    """Zones, sensors, share of each class and risk band per building.

    Readings are first reduced on the map side to one row per (building, zone, sensor); the
    distinct counts then run over those rows, spread by Spark over (building, value) pairs.
    """
    parts = (df.groupBy(building(ZONE).alias("building"), F.col(ZONE).alias("zone"), "sensor_id")
             .agg(F.count(F.lit(1)).alias("n"),
                  *[F.sum(indicator(TARGET, label)).alias(label) for label in LABELS]))
    per_building = parts.groupBy("building").agg(
        F.count_distinct("zone").alias("zones"), F.count_distinct("sensor_id").alias("sensors"),
        *[(F.sum(label) * 100 / F.sum("n")).alias(name) for label, name in zip(
            LABELS, ("normal_pct", "ventilation_pct", "thermal_pct"))])
    return with_risk(per_building, low_from, medium_from)


def with_risk(per_building: DataFrame, low_from: float, medium_from: float) -> DataFrame:
    risk = (F.when(F.col("normal_pct") >= low_from, "low")
            .when(F.col("normal_pct") >= medium_from, "medium").otherwise("alert"))
    return per_building.withColumn("risk", risk)


def floor_issue_rate(df: DataFrame, label: str = THERMAL) -> DataFrame:
    """Share of a class per floor, and its rise over the lowest floor, in percent."""
    rates = df.groupBy("floor_number").agg(_share(label).alias("issue_pct"))
    base = F.first_value("issue_pct").over(Window.orderBy("floor_number"))
    return rates.withColumn("rise_pct", F.try_divide(F.col("issue_pct") - base, base) * 100)


def zone_dimension(df: DataFrame, zones: Sequence[str] = ("Z01", "Z02", "Z03", "Z04")) -> DataFrame:
    """Every building with the listed zones and all others it has, and the readings seen in each.

    The readings are counted once per building and zone; only those counts are unfolded.
    """
    seen = df.groupBy(building(ZONE).alias("building"), zone_part(ZONE).alias("zone")).agg(
        F.count(F.lit(1)).alias("n"))
    both = F.array(F.struct("zone", "n"), *[
        F.struct(F.lit(z).alias("zone"), F.lit(0).cast("long").alias("n")) for z in zones])
    counted = seen.select("building", F.inline(both)).groupBy("building", "zone").agg(
        F.sum("n").alias("n_readings"))
    return counted.select(
        "building", "zone", F.concat_ws("-", "building", "zone").alias("building_zone"),
        "n_readings")
