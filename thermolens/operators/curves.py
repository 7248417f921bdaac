"""Scaling and cross-over analysis of timing series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def speedup_efficiency(df: DataFrame, series: str, resource: str = "cores",
                       time: str = "time_s") -> DataFrame:
    """Speed-up and parallel efficiency against the smallest resource count of each series.

    ``df`` has one row per measured resource count, so a series is a few rows long.
    """
    whole = Window.partitionBy(series)
    speedup = F.try_divide(F.min_by(time, resource).over(whole), F.col(time))
    factor = F.try_divide(F.col(resource).cast("double"), F.min(resource).over(whole))
    return df.select(series, resource, time, speedup.alias("speedup"),
                     F.try_divide(speedup, factor).alias("efficiency"))


def curve_crossover(df: DataFrame, series: str, size: str = "size", first: str = "first_time",
                    second: str = "second_time") -> DataFrame:
    """Sizes at which the first curve passes the second, by linear interpolation.

    ``df`` has one row per measured size, so a series is as long as a chart's axis.
    """
    window = Window.partitionBy(series).orderBy(size)
    gap = F.col(first) - F.col(second)
    steps = df.select(series, F.col(size).cast("double").alias("_x"), gap.alias("_g"),
                      F.lead(F.col(size).cast("double")).over(window).alias("_x2"),
                      F.lead(gap).over(window).alias("_g2"))
    crossed = steps.filter((F.col("_g") * F.col("_g2") < 0) | (F.col("_g") == 0))
    at = F.col("_x") + (F.col("_x2") - F.col("_x")) * F.col("_g") / (F.col("_g") - F.col("_g2"))
    return crossed.select(
        series, F.when(F.col("_g") == 0, F.col("_x")).otherwise(at).alias("crossover_size"))
