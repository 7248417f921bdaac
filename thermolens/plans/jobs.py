"""Jobs that chain several operators and write their results."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from thermolens.operators.correlation import association_of, correlation_matrix
from thermolens.operators.evaluate import classification_metrics
from thermolens.operators.features import add_physical_features, coerce_numeric, parse_time
from thermolens.operators.impute import GroupMedianImputer, GroupMedianModel
from thermolens.operators.ml import (check_categories, feature_pipeline, importance_table, predictions,
                                     top_importances, tune_forest, tuning_table)
from thermolens.operators.split import DEFAULT_CUTOFF, bernoulli_sample, split_by_cutoff
from thermolens.schema import (ENGINEERED, IMPUTED, PHYSICAL, TARGET, TIME, VECTOR_FEATURES, ZONE)
from thermolens.session import materialise, persisted, spread_rows
from thermolens.sources.guards import require_columns
from thermolens.sources.tables import (feature_metadata, read_table, write_csv, write_metadata,
                                       write_parquet)


@dataclass
class FittedSplit:
    """Train and test rows filled with medians learned on the train rows."""

    model: GroupMedianModel
    train: DataFrame
    test: DataFrame


def fit_train_apply_test(readings: DataFrame, cutoff: str = DEFAULT_CUTOFF, *,
                         check: bool = False) -> FittedSplit:
    train, test = split_by_cutoff(readings, cutoff, check=check)
    model = GroupMedianImputer().fit(train)

    def finish(df: DataFrame) -> DataFrame:
        return add_physical_features(coerce_numeric(model.transform(df), PHYSICAL))
    return FittedSplit(model, finish(train), finish(test))


def feature_job(spark: SparkSession, source: str | tuple[str, str], output: str,
                cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Read, split, impute, derive, write both sides, and analyse the written training side.

    ``source`` is one raw table, or an already split (train, test) pair. Returns the
    feature-class association.
    """
    if isinstance(source, str):
        raw = read_table(spark, source)
        require_columns(raw, [TIME, TARGET])
        fitted = fit_train_apply_test(parse_time(raw), cutoff, check=True)
    else:
        train, test = (read_table(spark, path) for path in source)
        model = GroupMedianImputer().fit(train)
        if train.isEmpty() or test.isEmpty():
            raise ValueError("Train or test split is empty")
        fitted = FittedSplit(model, *[add_physical_features(coerce_numeric(model.transform(d), PHYSICAL))
                                      for d in (train, test)])
    write_parquet(fitted.train, f"{output}/train_features.parquet")
    write_parquet(fitted.test, f"{output}/test_features.parquet")
    written = spark.read.parquet(f"{output}/train_features.parquet")
    matrix = materialise(correlation_matrix(written))
    write_csv(matrix, f"{output}/feature_correlation_matrix.csv", decimals=5)
    association = association_of(matrix)
    write_csv(association, f"{output}/feature_class_association.csv", decimals=5)
    return association


def pipeline_job(spark: SparkSession, train: DataFrame, output: str,
                 pipeline: Pipeline | None = None) -> PipelineModel:
    """Fit the feature pipeline on training rows; save it with its metadata."""
    check_categories(train, ZONE)
    with persisted(spread_rows(train)) as kept:
        model = (pipeline or feature_pipeline()).fit(kept)
    model.write().overwrite().save(f"{output}/model")
    write_metadata(spark, feature_metadata(VECTOR_FEATURES, IMPUTED, ENGINEERED),
                   f"{output}/metadata")
    return model


@dataclass
class Tuned:
    metrics: DataFrame
    table: DataFrame
    importances: DataFrame


def tuning_job(train: DataFrame, test: DataFrame, features: PipelineModel,
               output: str | None = None, share: float = 1.0) -> Tuned:
    """Search the forest grid, judge the best model on the test rows, optionally save it.

    ``share`` below 1 searches on a sample, for small machines only.
    """
    vectors = features.transform(spread_rows(train)).select("features", "label")
    with persisted(vectors if share >= 1 else bernoulli_sample(vectors, share)) as data:
        cv = tune_forest(data)
    scored = predictions(cv.bestModel.transform(features.transform(test)))
    if output:
        cv.bestModel.write().overwrite().save(output)
    return Tuned(classification_metrics(scored), tuning_table(cv, train),
                 top_importances(importance_table(cv.bestModel, VECTOR_FEATURES, train)))


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df: DataFrame) -> None:
    """Compute every row and column and keep nothing."""
    df.write.format("noop").mode("overwrite").save()
