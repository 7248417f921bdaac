"""Feature pipelines, classifiers, tuning and importances on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (Imputer, OneHotEncoder, StandardScaler, StringIndexer,
                                StringIndexerModel, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolens.operators.boosting import BoostedTrees
from thermolens.operators.forest import ForestClassifier
from thermolens.operators.impute import GroupMedianImputer, PhysicalFeatures
from thermolens.operators.newton import SoftmaxRegression
from thermolens.schema import (ID, IMPUTED, LABELS, MODEL_FEATURES, RATIOS, TARGET, VECTOR_FEATURES,
                               ZONE, ZONE_INDEX)

LABEL = "label"
SEED = 42
# Grid and folds of the forest search.
FOREST_GRID = {"maxDepth": (7, 10), "numTrees": (20, 40)}
FOLDS = 3
# StringIndexer keeps its labels on the driver, so it is only used below this many categories.
MAX_CATEGORIES = 100_000


def check_categories(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> None:
    """Refuse a category column too wide for an indexer, before its values reach the driver."""
    n = df.agg(F.approx_count_distinct(column)).first()[0]
    if n > limit:
        raise ValueError(f"{column} has about {n} categories; at most {limit} can be indexed")


class CheckedIndexer(StringIndexer):
    """A StringIndexer that refuses a column with too many categories before it reads them."""

    def _fit(self, dataset: DataFrame) -> StringIndexerModel:
        check_categories(dataset, self.getInputCol())
        return super()._fit(dataset)


def zone_indexer(column: str = ZONE, into: str = ZONE_INDEX) -> StringIndexer:
    """Index in alphabetical order; values not seen in training share one extra index."""
    return CheckedIndexer(inputCol=column, outputCol=into, stringOrderType="alphabetAsc",
                          handleInvalid="keep")


def frequency_indexer(column: str = TARGET, into: str = LABEL) -> StringIndexer:
    """Index by falling frequency, ties in alphabetical order."""
    return CheckedIndexer(inputCol=column, outputCol=into, stringOrderType="frequencyDesc",
                          handleInvalid="keep")


def label_encoder(labels: Sequence[str] = LABELS, invalid: str = "error") -> StringIndexerModel:
    """The fixed label order, so that codes do not depend on the data and no class is added."""
    return StringIndexerModel.from_labels(list(labels), inputCol=TARGET, outputCol=LABEL,
                                          handleInvalid=invalid)


def global_median_imputer(columns: Sequence[str] = IMPUTED) -> Imputer:
    """Spark's own imputer: one approximate median for the whole table."""
    return Imputer(inputCols=list(columns), outputCols=list(columns), strategy="median")


def cleaning_stages(group: str = ZONE) -> list:
    """Derive the physical features, then fill sensor gaps and undefined ratios.

    The features do not depend on the filled sensors, so one fit learns both sets of medians.
    """
    return [PhysicalFeatures(),
            GroupMedianImputer(groupCol=group, inputCols=[*IMPUTED, *RATIOS])]


def vector_stages(with_mean: bool = False, with_std: bool = True) -> list:
    """Zone index, 24-wide vector in fixed order, scaling by the sample standard deviation."""
    return [zone_indexer(),
            VectorAssembler(inputCols=list(VECTOR_FEATURES), outputCol="raw_features",
                            handleInvalid="error"),
            StandardScaler(inputCol="raw_features", outputCol="features", withStd=with_std,
                           withMean=with_mean)]


def feature_pipeline(include_label: bool = True, with_mean: bool = False,
                     with_std: bool = True) -> Pipeline:
    label = [label_encoder()] if include_label else []
    return Pipeline(stages=[*cleaning_stages(), *label, *vector_stages(with_mean, with_std)])


def onehot_pipeline(include_label: bool = True) -> Pipeline:
    """Z-scores of the 23 numeric columns followed by one column per known zone.

    The extra index of unseen zones is the one that the encoder drops: they become all zeros.
    """
    label = [label_encoder()] if include_label else []
    return Pipeline(stages=[
        *cleaning_stages(), *label,
        VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="numeric", handleInvalid="error"),
        StandardScaler(inputCol="numeric", outputCol="zscores", withMean=True, withStd=True),
        zone_indexer(),
        OneHotEncoder(inputCol=ZONE_INDEX, outputCol="zone_onehot", dropLast=True),
        VectorAssembler(inputCols=["zscores", "zone_onehot"], outputCol="features")])


def spread(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per name."""
    values = vector_to_array(F.col(vector))
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, values.alias("_v")).select(
        *rest, *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])


def forest(trees: int = 100, depth: int = 14, seed: int = SEED) -> ForestClassifier:
    """All trees in one model, a level of all of them in one scan."""
    return ForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)


def logistic_regression(tolerance: float = 1e-7) -> SoftmaxRegression:
    """Multinomial with a unit L2 penalty for all rows together.

    The inputs are z-scores already, so the penalty applies to them as they are.
    """
    return SoftmaxRegression(tolerance=tolerance)


def boosted_trees(rounds: int = 100, depth: int = 5) -> BoostedTrees:
    """All classes in one model, a tree for each class and round."""
    return BoostedTrees(rounds=rounds, depth=depth)


def tune_forest(train: DataFrame, grid: dict = FOREST_GRID, folds: int = FOLDS,
                parallelism: int = 2, seed: int = SEED) -> CrossValidatorModel:
    """Grid search by weighted F1 over folds, with one forest per fold for all grid points. Persist
    ``train``: it is read many times."""
    model = forest(seed=seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1")
    return CrossValidator(estimator=model, estimatorParamMaps=builder.build(), evaluator=evaluator,
                          numFolds=folds, parallelism=parallelism, seed=seed).fit(train)


def tuning_table(cv: CrossValidatorModel, template: DataFrame) -> DataFrame:
    """Parameters and mean score of every grid point (a handful of rows by construction)."""
    rows = [(float(score), {p.name: float(v) for p, v in point.items()})
            for point, score in zip(cv.getEstimatorParamMaps(), cv.avgMetrics)]
    names = sorted({n for _, point in rows for n in point})
    schema = ", ".join(f"{n} double" for n in names) + ", cv_f1 double"
    return template.sparkSession.createDataFrame(
        [(*[point[n] for n in names], score) for score, point in rows], schema)


def importance_table(model, names: Sequence[str], template: DataFrame) -> DataFrame:
    """(feature, importance) by the assembler's own input names; the vector is as wide as they are."""
    values = [float(v) for v in model.featureImportances.toArray()]
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances for {len(names)} names")
    return template.sparkSession.createDataFrame(
        list(zip(names, values)), "feature string, importance double")


def expanded_names(numeric: Sequence[str], column: str, categories: Sequence[str]) -> list[str]:
    """Vector names of numeric columns followed by a one-hot column."""
    return [*numeric, *[f"{column}={c}" for c in categories]]


def merge_onehot(importances: DataFrame) -> DataFrame:
    """Add the parts of a one-hot column back to the column they come from."""
    source = F.split(F.col("feature"), "=")[0]
    return importances.groupBy(source.alias("feature")).agg(
        F.sum("importance").alias("importance"))


def top_importances(importances: DataFrame, k: int = 15) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)


def fitted_zones(model: PipelineModel) -> list[str]:
    """The zone list of a fitted pipeline, in index order."""
    indexer = next(s for s in model.stages
                   if isinstance(s, StringIndexerModel) and s.getOutputCol() == ZONE_INDEX)
    return list(indexer.labels)


def predictions(scored: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """(reading_id, diagnostic_state, predicted) of a scored table."""
    names = F.array(*[F.lit(label) for label in labels])
    return scored.select(ID, TARGET, F.get(names, F.col("prediction").cast("int"))
                         .alias("predicted"))
