"""Median imputation learned per group on training rows only."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolens.functions.numeric import finite
from thermolens.operators.features import add_physical_features
from thermolens.operators.order_stats import RANKED_VALUES, widen
from thermolens.operators.sketches import exact_medians_by, facts_of, sketch_columns
from thermolens.schema import DELTA_INPUTS, IMPUTED, RATIO_INPUTS, ZONE
from thermolens.session import keep, lookup_join, materialise
from thermolens.sources.guards import raise_on_guard, require_columns


def group_medians(df: DataFrame, key: str = ZONE, columns: Sequence[str] = IMPUTED, *,
                  method: str = "exact", limit: int = RANKED_VALUES) -> DataFrame:
    """Median per group; a group without any value in a column gets that column's global median."""
    model = GroupMedianImputer(groupCol=key, inputCols=list(columns), method=method,
                               rankedValues=limit).fit(df)
    return model.complete_medians()


def global_medians(df: DataFrame, columns: Sequence[str] = IMPUTED, *, method: str = "exact",
                   limit: int = RANKED_VALUES) -> DataFrame:
    """One row with the median of each column over its non-null values."""
    clean = df.select(*[finite(c).alias(c) for c in columns])
    if method == "approx":
        return clean.agg(*[F.percentile_approx(c, 0.5).alias(c) for c in columns])
    long, _ = exact_medians_by(clean.withColumn("_everything", F.lit("all")), "_everything",
                               columns, limit=limit)
    return widen(long.filter("_everything is null"), [], columns)


class _MedianParams(Params):
    groupCol = Param(Params._dummy(), "groupCol", "column with the group key",
                     TypeConverters.toString)
    inputCols = Param(Params._dummy(), "inputCols", "columns to fill", TypeConverters.toListString)
    method = Param(Params._dummy(), "method", "exact or approx", TypeConverters.toString)
    rankedValues = Param(Params._dummy(), "rankedValues",
                         "distinct values of a group that one task may rank", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(groupCol=ZONE, inputCols=list(IMPUTED), method="exact",
                         rankedValues=RANKED_VALUES)

    @property
    def key(self) -> str:
        return self.getOrDefault(self.groupCol)

    @property
    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class GroupMedianImputer(_MedianParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a median per group and column, and a global one for the gaps.

    One scan sketches and counts the input, which is checked by these counts; a second one finds
    all medians, of groups and of the whole table (see ``sketches``).
    """

    @keyword_only
    def __init__(self, *, groupCol: str = ZONE, inputCols: Sequence[str] = IMPUTED,
                 method: str = "exact", rankedValues: int = RANKED_VALUES):
        super().__init__()
        self._set(**{k: list(v) if k == "inputCols" else v for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> GroupMedianModel:
        key, columns = self.key, self.columns
        require_columns(dataset, [key, *columns])
        clean = dataset.select(F.col(key).cast("string").alias(key),
                               *[finite(c).alias(c) for c in columns])
        state = materialise(sketch_columns(clean, key, columns))
        facts = facts_of(state, key, columns)
        raise_on_guard(facts, columns)
        groups = facts["groups"]
        kept = keep(self._medians(clean, key, columns, state, facts).select(key, *columns, "n"),
                    groups + 1)
        is_total = F.col(key).isNull()
        fitted = (kept.table.filter(is_total).first() if kept.rows is None
                  else next(row for row in kept.rows if row[key] is None))
        model = GroupMedianModel(kept.table.filter(~is_total), {c: fitted[c] for c in columns},
                                 groups)
        return self._copyValues(model)

    def _medians(self, clean: DataFrame, key: str, columns: list[str], state: DataFrame,
                 facts: dict[str, int]) -> DataFrame:
        """Wide medians and row count ``n`` per group and, with a null key, of all rows."""
        if self.getOrDefault(self.method) == "approx":
            picked = [*[F.percentile_approx(c, 0.5).alias(c) for c in columns],
                      F.count(F.lit(1)).alias("n")]
            total = clean.agg(*picked).withColumn(key, F.lit(None).cast("string"))
            return clean.groupBy(key).agg(*picked).unionByName(total)
        long, _ = exact_medians_by(clean, key, columns, state, facts,
                                   self.getOrDefault(self.rankedValues))
        return widen(long, [key], columns, F.max("n").alias("n"))


class GroupMedianModel(_MedianParams, Model, MLReadable, MLWritable):
    """Fills gaps from the group's median, or from the global one for unseen or empty groups."""

    def __init__(self, medians: DataFrame | None = None, fallback: dict[str, float] | None = None,
                 groups: int = 0):
        super().__init__()
        self.medians, self.fallback, self.groups = medians, fallback or {}, groups

    def complete_medians(self) -> DataFrame:
        return self.medians.select(self.key, *[
            F.coalesce(F.col(c), F.lit(self.fallback[c])).alias(c) for c in self.columns])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.medians is None:
            raise RuntimeError("This model has not been fitted")
        key, columns = self.key, self.columns
        require_columns(dataset, [key, *columns])
        table = self.medians.select(
            F.col(key).alias("_key"), *[F.col(c).alias(f"_m_{c}") for c in columns], "n")
        # A null key is an error wherever the row is computed; no extra job looks for it.
        checked = F.coalesce(F.col(key).cast("string"),
                             F.raise_error(F.lit(f"{key} contains null values")).cast("string"))
        joined = lookup_join(dataset.withColumn("_key", checked), table, ["_key"], self.groups,
                             weight="n")
        filled = {c: F.coalesce(finite(c), F.col(f"_m_{c}"), F.lit(self.fallback[c]))
                  for c in columns}
        return joined.select(*[filled[c].alias(c) if c in filled else F.col(c)
                               for c in dataset.columns])

    def copy(self, extra=None):
        copied = super().copy(extra)
        copied.medians, copied.fallback, copied.groups = self.medians, self.fallback, self.groups
        return copied

    def write(self):
        return _GroupMedianWriter(self)

    @classmethod
    def read(cls):
        return _GroupMedianReader()


class _GroupMedianWriter(MLWriter):
    def __init__(self, instance: GroupMedianModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        model = self.instance
        state = {"fallback": json.dumps(model.fallback), "groups": model.groups}
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession, extraMetadata=state)
        model.medians.write.parquet(f"{path}/medians")


class _GroupMedianReader(MLReader):
    def load(self, path: str) -> GroupMedianModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = GroupMedianModel(spark.read.parquet(f"{path}/medians"),
                                 json.loads(metadata["fallback"]), metadata["groups"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class PhysicalFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage that cleans the physical inputs and adds the five engineered columns."""

    policy = Param(Params._dummy(), "policy", "null, add_epsilon or clamp_epsilon",
                   TypeConverters.toString)

    @keyword_only
    def __init__(self, *, policy: str = "null"):
        super().__init__()
        self._setDefault(policy="null")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = {c for pair in (*DELTA_INPUTS.values(), *RATIO_INPUTS.values()) for c in pair}
        require_columns(dataset, inputs)
        clean = dataset.withColumns({
            c: finite(c) for c in sorted(inputs)
            if not isinstance(dataset.schema[c].dataType, T.IntegralType)})
        return add_physical_features(clean, self.getOrDefault(self.policy))


def impute_global(df: DataFrame, columns: Sequence[str] = IMPUTED, *,
                  fitted_on: DataFrame | None = None) -> DataFrame:
    """Fill gaps with the exact median of the whole (training) table; one value per column."""
    row = global_medians(fitted_on if fitted_on is not None else df, columns).first()
    return df.withColumns({c: F.coalesce(finite(c), F.lit(row[c])) for c in columns})
