"""Streaming scoring and quality counters.

Fitted medians and models are frozen tables, so every micro-batch is a map over the new rows; the
only state kept is that of the windowed counters, bounded by their watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from thermolens.operators.features import add_physical_features
from thermolens.operators.impute import GroupMedianModel
from thermolens.operators.rules import recommendations, rule_diagnosis
from thermolens.operators.scoring import diagnose
from thermolens.schema import IMPUTED, TIME, ZONE


def read_stream(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema)
    if kind == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def diagnose_stream(stream: DataFrame, medians: GroupMedianModel) -> DataFrame:
    """Impute with frozen medians, add the physical features, apply the rules."""
    filled = add_physical_features(medians.transform(stream))
    return recommendations(rule_diagnosis(filled))


def score_stream(stream: DataFrame, features: PipelineModel, classifier: Model) -> DataFrame:
    """The batch answer of :func:`thermolens.operators.scoring.diagnose` for every new row."""
    return diagnose(stream, features, classifier)


def with_event_time(stream: DataFrame, delay: str = "1 hour", column: str = TIME) -> DataFrame:
    """Watermarks need a time stamp with zone; the wall clock is read as session time (UTC)."""
    return (stream.withColumn("event_time", F.col(column).cast("timestamp"))
            .withWatermark("event_time", delay))


def null_profile_stream(stream: DataFrame, delay: str = "1 hour", window: str = "30 minutes",
                        key: str = ZONE, columns: Sequence[str] = IMPUTED) -> DataFrame:
    """Null counts per zone and half hour. Rows later than ``delay`` are dropped."""
    slots = with_event_time(stream, delay).withColumn("_w", F.window("event_time", window))
    counted = slots.groupBy("_w", key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    return counted.select(
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"), key, "n",
        *[f"null_{c}" for c in columns])


def run_to_files(result: DataFrame, path: str, checkpoint: str,
                 mode: str = "append") -> StreamingQuery:
    """Process what is there, write Parquet exactly once per batch, and stop."""
    query = (result.writeStream.format("parquet").outputMode(mode)
             .option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def run_updates_to_files(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's changed groups under its batch id; a repeated batch overwrites itself."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    query = (result.writeStream.foreachBatch(store).outputMode("update")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of a table written by :func:`run_updates_to_files`."""
    updates = spark.read.option("basePath", path).parquet(path)
    values = [c for c in updates.columns if c not in {*keys, "batch_id"}]
    newest = updates.groupBy(*keys).agg(
        F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return newest.select(*keys, "_v.*")


def batch_null_profile(df: DataFrame, window: str = "30 minutes", key: str = ZONE,
                       columns: Sequence[str] = IMPUTED) -> DataFrame:
    """The batch result that the stream must agree with."""
    slot = F.window(F.col(TIME).cast("timestamp"), window)["start"].cast("timestamp_ntz")
    df = df.withColumn("window_start", slot)
    return df.groupBy("window_start", key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
