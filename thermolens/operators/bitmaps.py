"""Exact distinct counts that can be added up: bitmaps over coded values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolens.functions.labels import building, indicator
from thermolens.operators.rollup import with_risk
from thermolens.schema import LABELS, TARGET, ZONE

COUNTED = ("zone", "sensor")


class CodeBook:
    """A code for every value of a few columns, in files under ``path``; codes never change.

    New values are appended with numbers after the largest one so far. They are numbered where they
    lie, without one task seeing all, so numbers have gaps between tasks; within a task they are
    dense, and so are the bitmaps.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        schema = "kind string, value string, code long"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def learn(self, values: DataFrame) -> None:
        """Add the new ones among the distinct (kind, value) of ``values``; nulls have no code."""
        known = self.table()
        first = (known.agg(F.max("code")).first()[0] or 0) + 1
        fresh = values.filter("value is not null").select("kind", "value").distinct().join(
            known, ["kind", "value"], "left_anti")
        fresh.withColumn("code", F.monotonically_increasing_id() + first).write.mode(
            "append").parquet(self.path)


def _values(df: DataFrame) -> DataFrame:
    """(building, kind, value) of every reading."""
    return df.select(building(ZONE).alias("building"), F.inline(F.array(
        F.struct(F.lit("zone").alias("kind"), F.col(ZONE).alias("value")),
        F.struct(F.lit("sensor").alias("kind"), F.col("sensor_id").alias("value")))))


def building_state(df: DataFrame, book: CodeBook) -> DataFrame:
    """(building, kind, bucket, bitmap, n, one count per class): what a batch of readings adds.

    Rows with a kind hold one bitmap of 32,768 codes each; the one without holds the counts.
    """
    pairs = _values(df).distinct()
    book.learn(pairs)
    coded = pairs.join(book.table(), ["kind", "value"])
    maps = coded.groupBy("building", "kind", F.bitmap_bucket_number("code").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bitmap"))
    counts = df.groupBy(building(ZONE).alias("building")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(indicator(TARGET, c)).alias(c) for c in LABELS])
    return maps.unionByName(counts, allowMissingColumns=True)


def merge_states(states: Sequence[DataFrame]) -> DataFrame:
    """The state of all batches together; the same reading must not be in two of them."""
    return reduce(DataFrame.unionByName, states).groupBy("building", "kind", "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("n").alias("n"),
        *[F.sum(c).alias(c) for c in LABELS])


def rollup_of(state: DataFrame, low_from: float = 75.0, medium_from: float = 72.0) -> DataFrame:
    """The roll-up per building of a state: zones, sensors, share of each class, risk band."""
    def distinct(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bitmap"))), F.lit(0))

    per_building = state.groupBy("building").agg(
        *[distinct(kind).alias(f"{kind}s") for kind in COUNTED],
        *[(F.sum(c) * 100 / F.sum("n")).alias(name) for c, name in zip(
            LABELS, ("normal_pct", "ventilation_pct", "thermal_pct"))])
    return with_risk(per_building, low_from, medium_from)
