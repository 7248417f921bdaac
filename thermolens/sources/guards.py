"""Checks on input tables, each a single pass at most."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError("Missing required columns: " + ", ".join(missing))


def guard_report(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: rows, rows without key, and observed values of each column - in one job."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        *[F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
          .alias(f"observed_{c}") for c in columns])


def check_training_input(df: DataFrame, key: str, columns: Sequence[str]) -> None:
    """Raise when there are no rows, a key is null, or a column has no value at all."""
    require_columns(df, [key, *columns])
    raise_on_guard(guard_report(df, key, columns).first().asDict(), columns)


def raise_on_guard(report: Mapping[str, int], columns: Sequence[str]) -> None:
    if not report["n_rows"]:
        raise ValueError("Training data is empty")
    if report["null_keys"]:
        raise ValueError("The group column contains null values")
    empty = [c for c in columns if not report[f"observed_{c}"]]
    if empty:
        raise ValueError("No observed training values in: " + ", ".join(empty))
