"""Projections over readings: cleaning, physical features, defaults, bands and range checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolens.functions.labels import (building, indicator, label_code, wall_clock, zone_floor,
                                         zone_part)
from thermolens.functions.numeric import band, difference, finite, guarded_ratio
from thermolens.schema import (DELTA_INPUTS, IMPUTED, LABELS, MODEL_FEATURES, PHYSICAL,
                               RATIO_INPUTS, SCORING_DEFAULTS, TARGET, TIME, VALID_RANGES, ZONE)
from thermolens.sources.guards import require_columns

# Band limits (exclusive upper bounds) of the alert displays.
BANDS = {
    "co2_ppm": (((1000, "safe"), (1400, "warning")), "danger"),
    "pm25_ug_m3": (((35, "good"), (75, "moderate")), "polluted"),
    "filter_pressure_pa": (((125, "clean"),), "clogged"),
}


def coerce_numeric(df: DataFrame, columns: Sequence[str] = IMPUTED + PHYSICAL) -> DataFrame:
    """The given columns as finite doubles or null. Text is parsed in a projection of its own."""
    kinds = dict(df.dtypes)
    text = {c: F.col(c).try_cast("double") for c in columns if kinds.get(c) == "string"}
    return df.withColumns(text).withColumns({c: finite(c) for c in columns if c in kinds})


def add_deltas(df: DataFrame) -> DataFrame:
    return df.withColumns({out: difference(*ins) for out, ins in DELTA_INPUTS.items()})


def add_ratios(df: DataFrame, policy: str = "null") -> DataFrame:
    return df.withColumns({out: guarded_ratio(*ins, policy) for out, ins in RATIO_INPUTS.items()})


def add_physical_features(df: DataFrame, policy: str = "null") -> DataFrame:
    """All five engineered columns, computed (or computed anew) from their inputs."""
    return add_ratios(add_deltas(df), policy)


def enrich(df: DataFrame) -> DataFrame:
    """Clean the numeric columns, then add each engineered column that is absent and computable."""
    have = set(df.columns)
    cleaned = coerce_numeric(df)
    wanted = {out: difference(*ins) for out, ins in DELTA_INPUTS.items()
              if out not in have and have.issuperset(ins)}
    wanted |= {out: guarded_ratio(*ins) for out, ins in RATIO_INPUTS.items()
               if out not in have and have.issuperset(ins)}
    return cleaned.withColumns(wanted) if wanted else cleaned


def parse_time(df: DataFrame, column: str = TIME, into: str | None = None) -> DataFrame:
    return df.withColumn(into or column, wall_clock(column))


def convert_timezone(df: DataFrame, to_zone: str, column: str = TIME, into: str | None = None,
                     from_zone: str = "UTC") -> DataFrame:
    """Shift a zone-less time stamp from one zone's wall clock to another's."""
    return df.withColumn(into or column, F.convert_timezone(
        F.lit(from_zone), F.lit(to_zone), F.col(column)))


def add_label_indicators(df: DataFrame, column: str = TARGET,
                         labels: Sequence[str] = LABELS) -> DataFrame:
    return df.withColumns({f"state_{label}": indicator(column, label) for label in labels})


def encode_label(df: DataFrame, column: str = TARGET, into: str = "label_code",
                 labels: Sequence[str] = LABELS) -> DataFrame:
    return df.withColumn(into, label_code(column, labels))


def apply_defaults(df: DataFrame, defaults: Mapping[str, object] = SCORING_DEFAULTS) -> DataFrame:
    """Add absent columns with their default; a null in a present column stays null."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def add_bands(df: DataFrame, bands: Mapping[str, tuple] = BANDS) -> DataFrame:
    return df.withColumns({f"{c}_band": band(c, limits, top)
                           for c, (limits, top) in bands.items()})


def range_violations(df: DataFrame,
                     ranges: Mapping[str, tuple[float, float]] = VALID_RANGES) -> DataFrame:
    """(column, below, above) counts for every checked column, from one pass."""
    wide = df.agg(*[e for c, (low, high) in ranges.items() for e in (
        F.count_if(F.col(c) < low).alias(f"{c}|below"),
        F.count_if(F.col(c) > high).alias(f"{c}|above"))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}|below").alias("below"),
                 F.col(f"{c}|above").alias("above")) for c in ranges])))


def parse_zone(df: DataFrame, column: str = ZONE) -> DataFrame:
    return df.withColumns({"building": building(column), "zone": zone_part(column),
                           "zone_floor": zone_floor(column)})


def project_features(df: DataFrame, features: Sequence[str] = MODEL_FEATURES,
                     keep: Sequence[str] = (ZONE, TARGET)) -> DataFrame:
    """The model inputs in their fixed order; absent columns are an error."""
    require_columns(df, [*features, *keep])
    return df.select(*keep, *features)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
