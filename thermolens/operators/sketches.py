"""Exact medians from mergeable quantile sketches: one scan sketches, a second one looks between
two bounds.

The sketches (KLL) are small, can be stored, and those of several days add up to those of all days.
They tell, with a margin, between which two values a median must lie. An exact scan then counts the
rows under the lower bound, and the different values between the bounds, which are a few hundredths
of the rows. If the margin was ever too small, the counts tell, and the median is found by counting
alone (``order_stats``); results never depend on the sketches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolens.operators.order_stats import (RANKED_VALUES, medians_with_total, middle_of,
                                              middle_ranks, rank_hits)
from thermolens.session import keep, lookup_join, materialise

#: Values that a sketch keeps on its lowest level; its rank error is about 0.4 hundredths.
SIZE = 1024
#: Room on both sides of the middle, as a share of the rows: some three times that error.
MARGIN = 0.0125


def sketch_columns(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, rows, and per column n_<column>, s_<column>): the sketches of every group, null being
    a group, in one aggregate with map-side combine. Values are doubles without NaN."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        *[made for c in columns for made in (
            F.count(c).alias(f"n_{c}"), F.kll_sketch_agg_double(c, F.lit(SIZE)).alias(f"s_{c}"))])


def merge_sketches(states: Sequence[DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """The sketches of all rows that any of ``states`` has seen, such as of one more day."""
    return reduce(DataFrame.unionByName, states).groupBy(key).agg(
        F.sum("rows").alias("rows"),
        *[made for c in columns for made in (
            F.sum(f"n_{c}").alias(f"n_{c}"), F.kll_merge_agg_double(f"s_{c}").alias(f"s_{c}"))])


def with_total(state: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The state with a column _all and one more row for all groups together; no row is read."""
    total = merge_sketches([state.withColumn(key, F.lit(""))], key, columns)
    return state.withColumn("_all", F.lit(False)).unionByName(
        total.withColumn("_all", F.lit(True)))


def bounds_of(state: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(_all, key, and per column a struct of n, lo and hi) between which the median must lie."""
    def bound(column: str, share: float):
        return F.when(F.col(f"n_{column}") > 0,
                      F.kll_sketch_get_quantile_double(f"s_{column}", F.lit(share)))
    return state.select("_all", key, "rows", *[
        F.struct(F.col(f"n_{c}").alias("n"), bound(c, 0.5 - MARGIN).alias("lo"),
                 bound(c, 0.5 + MARGIN).alias("hi")).alias(f"b_{c}") for c in columns])


def medians_between(df: DataFrame, bounds: DataFrame, key: str, columns: Sequence[str],
                    groups: int) -> DataFrame:
    """(_all, key, column, median, n) of the groups whose median lies between its bounds.

    Every value meets the bounds of its group and of the total. One that lies under them is only
    counted, with its group; one between them is counted by value; the others are dropped at once.
    """
    own = bounds.filter(~F.col("_all")).select(
        key, "rows", F.struct(*[f"b_{c}" for c in columns]).alias("_own"))
    whole = bounds.filter("_all").select(F.struct(*[f"b_{c}" for c in columns]).alias("_whole"))
    met = lookup_join(df.select(key, *columns), own, [key], groups, "inner", weight="rows").join(
        F.broadcast(whole))  # one row

    def entry(column: str, side: str, is_all: bool):
        value, b = F.col(column), F.col(f"{side}.b_{column}")
        return F.when(value <= b["hi"], F.struct(
            F.lit(is_all).alias("_all"), (F.lit("") if is_all else F.col(key)).alias("_key"),
            F.lit(column).alias("column"), F.when(value >= b["lo"], value).alias("value"),
            b["n"].alias("_n")))

    entries = F.explode(F.filter(F.array(*[
        entry(c, side, is_all) for c in columns
        for side, is_all in (("_own", False), ("_whole", True))]), lambda e: e.isNotNull()))
    scope = ["_all", "_key", "column"]
    counted = met.select(entries.alias("_e")).select("_e.*").groupBy(*scope, "value").agg(
        F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    # Null comes first in order: the rows under the lower bound.
    hit = rank_hits(counted, scope, "value", middle_ranks).filter(F.col("low").isNotNull())
    return hit.select("_all", F.col("_key").alias(key), "column", middle_of(), "n")


def facts_of(state: DataFrame, key: str, columns: Sequence[str]) -> dict[str, int]:
    """n_rows, null_keys, groups, observed_<column>, the most values of a group (``most``) and the
    number of medians there are (``filled``), from a state; no row is read."""
    return state.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("rows"))), F.lit(0)).alias("null_keys"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.max(F.greatest(*[F.col(f"n_{c}") for c in columns], F.lit(0))), F.lit(0))
        .alias("most"),
        *[F.coalesce(F.sum(f"n_{c}"), F.lit(0)).alias(f"observed_{c}") for c in columns],
        F.coalesce(F.sum(sum((F.col(f"n_{c}") > 0).cast("long") for c in columns)), F.lit(0))
        .alias("filled")).first().asDict()


def exact_medians_by(df: DataFrame, key: str, columns: Sequence[str],
                     state: DataFrame | None = None, facts: dict[str, int] | None = None,
                     limit: int = RANKED_VALUES) -> tuple[DataFrame, DataFrame]:
    """(key, column, median, n) per group and, with a null key, over all rows; and the state.

    ``state`` may be that of an earlier run, merged with the sketches of new rows; ``df`` has all
    rows then. Without one it is made. ``key`` must not be null. If some group has so many rows that
    more than ``limit`` different values may lie between its bounds, all is found by counting, which
    spreads one group over many tasks. ``facts`` say that ``state`` is written already.
    """
    made = state if facts else materialise(
        state if state is not None else sketch_columns(df, key, columns))
    facts = facts or facts_of(made, key, columns)
    totals = [facts[f"observed_{c}"] for c in columns]
    if not facts["groups"] or max(facts["most"], *totals) * 2 * MARGIN > limit:
        return medians_with_total(df, key, columns, limit), made
    bounds = bounds_of(with_total(made, key, columns), key, columns)
    medians = facts["filled"] + sum(n > 0 for n in totals)
    found = keep(medians_between(df, bounds, key, columns, facts["groups"]), medians)
    if (len(found.rows) if found.rows is not None else found.table.count()) < medians:
        return medians_with_total(df, key, columns, limit), made  # a margin was too small
    return found.table.select(
        F.when(~F.col("_all"), F.col(key)).alias(key), "column", "median", "n"), made
