"""Classification quality from (actual, predicted) columns.

The rows are reduced once to at most labels x labels counts; everything else works on those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolens.schema import LABELS, TARGET


def outcome_counts(df: DataFrame, actual: str = TARGET, predicted: str = "predicted") -> DataFrame:
    return (df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(df: DataFrame, actual: str = TARGET, predicted: str = "predicted",
                     labels: Sequence[str] = LABELS) -> DataFrame:
    """One row per actual class; counts and row percentages of every predicted class.

    Predictions outside ``labels`` count towards the row total only.
    """
    counts = outcome_counts(df, actual, predicted)
    cells = {label: F.coalesce(F.sum(F.when(F.col("predicted") == label, F.col("n"))), F.lit(0))
             for label in labels}
    table = counts.groupBy("actual").agg(
        *[c.alias(label) for label, c in cells.items()], F.sum("n").alias("_total"))
    return table.select("actual", *labels, *[
        (F.col(label) * F.lit(100.0) / F.col("_total")).alias(f"{label}_pct") for label in labels])


def _per_class(df: DataFrame, actual: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """tp, support and predicted count per class, as rows of a fixed label list."""
    counts = outcome_counts(df, actual, predicted)

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    a, p = F.col("actual"), F.col("predicted")
    wide = counts.agg(F.sum("n").alias("n"), *[e for label in labels for e in (
        total((a == label) & (p == label)).alias(f"tp|{label}"),
        total(a == label).alias(f"support|{label}"),
        total(p == label).alias(f"called|{label}"))])
    rows = wide.select("n", F.inline(F.array(*[
        F.struct(F.lit(label).alias("label"), F.col(f"`tp|{label}`").alias("tp"),
                 F.col(f"`support|{label}`").alias("support"),
                 F.col(f"`called|{label}`").alias("called")) for label in labels])))
    zero = F.lit(0.0)
    tp = F.col("tp").cast("double")
    return rows.withColumns({
        "precision": F.coalesce(F.try_divide(tp, F.col("called")), zero),
        "recall": F.coalesce(F.try_divide(tp, F.col("support")), zero),
        "f1": F.coalesce(F.try_divide(2 * tp, F.col("called") + F.col("support")), zero)})


def _weighted(name: str) -> Column:
    return F.coalesce(F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support")),
                      F.lit(0.0)).alias(name)


def classification_metrics(df: DataFrame, actual: str = TARGET, predicted: str = "predicted",
                           labels: Sequence[str] = LABELS) -> DataFrame:
    """Accuracy, macro-F1 and weighted-F1 in one row."""
    rows = _per_class(df, actual, predicted, labels)
    return rows.agg(
        F.coalesce(F.try_divide(F.sum("tp").cast("double"), F.max("n")), F.lit(0.0))
        .alias("accuracy"),
        F.avg("f1").alias("macro_f1"), _weighted("f1").alias("weighted_f1"))


def classification_report(df: DataFrame, actual: str = TARGET, predicted: str = "predicted",
                          labels: Sequence[str] = LABELS) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    scores = ("precision", "recall", "f1")
    rows = _per_class(df, actual, predicted, labels).select("label", *scores, "support")
    macro = rows.agg(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores],
                     F.sum("support").alias("support"))
    weighted = rows.agg(F.lit("weighted avg").alias("label"), *[_weighted(s) for s in scores],
                        F.sum("support").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)
