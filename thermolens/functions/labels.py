"""Class labels, zone keys and time stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermolens.schema import LABELS


def label_code(name: str, labels: Sequence[str] = LABELS) -> Column:
    """Integer code by position in ``labels``; null for any other text."""
    codes = F.create_map(*[F.lit(x) for i, label in enumerate(labels) for x in (label, i)])
    return F.try_element_at(codes, F.col(name))


def label_name(code: Column, labels: Sequence[str] = LABELS) -> Column:
    return F.get(F.array(*[F.lit(label) for label in labels]), code.cast("int"))


def indicator(name: str, label: str) -> Column:
    """1.0 where the column equals the label, else 0.0 (also for null)."""
    return F.when(F.col(name) == label, 1.0).otherwise(0.0)


def building(zone: str) -> Column:
    return F.split(F.col(zone), "-")[0]


def zone_part(zone: str) -> Column:
    return F.split(F.col(zone), "-")[1]


def zone_floor(zone: str) -> Column:
    return F.regexp_replace(zone_part(zone), "Z", "").try_cast("int")


def wall_clock(name: str) -> Column:
    """Parse to a time stamp without zone; text that is no time becomes null."""
    return F.col(name).try_cast("timestamp_ntz")


def micros(column: Column) -> Column:
    """Microseconds since 1970 of a zone-less time stamp, read as UTC in any session."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, column)
