"""Counts, distributions, null profiles and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermolens.schema import IMPUTED, TARGET, TIME, ZONE

SPREADSHEET_ROWS = 1_048_576


def row_count_limit(df: DataFrame, limit: int = SPREADSHEET_ROWS) -> DataFrame:
    """Rows, and how many of them a sheet of ``limit`` rows would lose."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("n_rows"), F.lit(limit).cast("bigint").alias("row_limit"),
                  (n > limit).alias("over_limit"),
                  F.greatest(n - limit, F.lit(0)).cast("bigint").alias("overflow_rows"))


def label_distribution(df: DataFrame, column: str = TARGET) -> DataFrame:
    """Count and percentage of every class; the window runs over one row per class."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(column, "n", F.round(F.col("n") * F.lit(100.0) / total, 2)
                         .alias("percentage"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_null) for every column, from one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "n_null")


def null_profile_by(df: DataFrame, key: str = ZONE, columns: Sequence[str] = IMPUTED) -> DataFrame:
    return df.groupBy(key).agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}")
                                 for c in columns])


def observed_counts(df: DataFrame, key: str = ZONE, columns: Sequence[str] = IMPUTED) -> DataFrame:
    """Values per group and column that are neither null nor NaN."""
    return df.groupBy(key).agg(*[
        F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).alias(f"observed_{c}")
        for c in columns])


def pair_counts(df: DataFrame, first: str = "firmware_version", second: str = TARGET) -> DataFrame:
    return (df.groupBy(first, second).agg(F.count(F.lit(1)).alias("n")).orderBy(first, second))


def group_summary(df: DataFrame, key: str = ZONE, temperature: str = "indoor_temp_c",
                  power: str = "hvac_power_kw") -> DataFrame:
    return df.groupBy(key).agg(
        F.avg(temperature).alias("avg_temp"), F.avg(power).alias("avg_power"),
        F.count(F.lit(1)).alias("n"))


def average(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias(f"avg_{column}"))


def time_range_by(df: DataFrame, key: Column, name: str = "split", column: str = TIME) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(
        F.min(column).alias("first_at"), F.max(column).alias("last_at"),
        F.count(F.lit(1)).alias("n"))
