"""Exact ranks, medians and rank boundaries for groups of any size.

A group may hold a third of all rows, so no operator here sorts the rows of a group in one task.
Rows are first reduced to (group, value, count): a hash aggregate that is combined on the map
side and spreads even one hot group over all reducers. Only those distinct values are ranked,
and only when a group is known to have at most ``limit`` of them, a bound on one task's memory.
Otherwise the search is first narrowed to the values between two approximate percentiles around
the wanted rank. Percentiles follow the rows, not the range of values, so one narrowing keeps
about four of CELLS parts of a group's rows whatever their distribution: two scans divide the
rows to rank by some 250. Results are exact, and do not depend on which way they were found.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermolens.functions.labels import micros
from thermolens.session import Kept, keep, lookup_join, materialise

RANKED_VALUES = 200_000
CELLS = 1024
# Rank error of the percentiles, as a share of the rows: a tenth of a cell.
ACCURACY = 10 * CELLS

RankRule = Callable[[Column], Sequence[Column]]


def middle_ranks(n: Column) -> Sequence[Column]:
    """The one or two zero-based ranks whose mean is the median of ``n`` values."""
    return F.floor((n - 1) / 2), F.floor(n / 2)


def value_counts(obs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return obs.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))


def group_sizes(obs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows, range and approximate distinct values of every group."""
    return obs.groupBy(*keys).agg(
        F.count(value).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"),
        F.approx_count_distinct(value).alias("_d"))


def rank_counted(counted: DataFrame, keys: Sequence[str], value: str, ranks: RankRule,
                 below: str | None = None) -> DataFrame:
    """Pick ranks from distinct values with counts.

    Returns the keys, ``n`` (rows), ``low`` / ``high`` (values at the first / last rank),
    ``below`` (rows strictly under ``low``) and ``equal`` (rows at ``low``).
    """
    whole = Window.partitionBy(*keys)
    running = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.select(
        *keys, value, F.sum("_c").over(running).alias("_end"),
        (F.sum("_c").over(running) - F.col("_c")).alias("_start"),
        F.sum("_c").over(whole).alias("_n"))
    first, last = ranks(F.col("_n"))
    hit = ranked.filter((F.col("_start") <= last) & (F.col("_end") > first))
    return hit.groupBy(*keys).agg(
        F.max("_n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.min("_start").alias("below"), F.min_by(F.col("_end") - F.col("_start"), value)
        .alias("equal"))


def rank_hits(counted: DataFrame, keys: Sequence[str], value: str, ranks: RankRule) -> DataFrame:
    """(keys, n, low, high) at the ranks of each group, whose ``_n`` rows ``counted`` tells from the
    smallest value on, perhaps not to the end; a null value stands for all that are smaller than the
    others. Groups whose last rank is not reached, or whose first is a null, have a null ``low``."""
    running = (Window.partitionBy(*keys).orderBy(F.asc_nulls_first(value))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ended = counted.withColumn("_end", F.sum("_c").over(running))
    first, last = ranks(F.col("_n"))
    hit = ended.filter((F.col("_end") - F.col("_c") <= last) & (F.col("_end") > first))
    whole = F.count_if(F.col(value).isNull()) + F.when(F.max("_end") > F.max(last), 0).otherwise(1)
    return hit.groupBy(*keys).agg(
        F.max("_n").alias("n"), F.when(whole == 0, F.min(value)).alias("low"),
        F.max(value).alias("high"))


def select_ranks(obs: DataFrame, keys: Sequence[str], value: str, ranks: RankRule,
                 limit: int = RANKED_VALUES) -> DataFrame:
    """Exact values at the ranks given by ``ranks(n)``, for each group of ``keys``.

    ``obs`` holds non-null values only. ``keys`` must not be empty or null. See
    :func:`rank_counted` for the columns returned.
    """
    keys = list(keys)
    sizes = materialise(group_sizes(obs, keys, value))
    widest = sizes.agg(F.max("_d")).first()[0] or 0
    if widest <= limit:
        return rank_counted(value_counts(obs, keys, value), keys, value, ranks)
    return _select_by_narrowing(obs, keys, value, ranks, sizes, limit)


def _select_by_narrowing(obs: DataFrame, keys: list[str], value: str, ranks: RankRule,
                         sizes: DataFrame, limit: int) -> DataFrame:
    """The range of ranks of each group, between two bounds that are narrowed until few distinct
    values lie between them, or no fewer are left."""
    first, last = ranks(F.col("_n"))
    bounds = materialise(sizes.select(
        *keys, "_n", "_lo", "_hi", "_d", F.col("_n").alias("_inside"),
        F.lit(0).cast("bigint").alias("_below"),
        first.cast("bigint").alias("_first"), last.cast("bigint").alias("_last")))
    before = None
    while True:
        wide = F.col("_d") > limit
        rows, left = bounds.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.when(wide, F.col("_inside"))), F.lit(0))).first()
        if not left or left == before:
            break
        before = left
        bounds = materialise(bounds.filter(~wide).unionByName(
            _narrow(obs, keys, value, bounds.filter(wide), rows)))

    target = [*keys, "_first", "_last"]
    counted = _inside(obs, keys, value, bounds, rows).groupBy(*target, value).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_below").alias("_below"), F.max("_n").alias("_n"))
    hit = _hits(counted, target, value)
    return hit.groupBy(*keys).agg(
        F.max("_n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.min("_start").alias("below"), F.min_by("_c", value).alias("equal"))


def _hits(counted: DataFrame, target: list[str], order: str) -> DataFrame:
    """Those counted values (or cells) of each target that hold one of its ranks."""
    window = (Window.partitionBy(*target).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ended = counted.withColumn("_end", F.col("_below") + F.sum("_c").over(window))
    return ended.withColumn("_start", F.col("_end") - F.col("_c")).filter(
        (F.col("_start") <= F.col("_last")) & (F.col("_end") > F.col("_first")))


def _inside(obs: DataFrame, keys: list[str], value: str, bounds: DataFrame, rows: int) -> DataFrame:
    """Observations between the bounds of a target of their group."""
    joined = lookup_join(obs, bounds, keys, rows, how="inner", weight="_n")
    return joined.filter(F.col(value).between(F.col("_lo"), F.col("_hi")))


def _narrow(obs: DataFrame, keys: list[str], value: str, wide: DataFrame, rows: int) -> DataFrame:
    """Replace the bounds of each target by percentiles on both sides of its ranks."""
    target = [*keys, "_n", "_lo", "_hi", "_below", "_first", "_last"]
    grid = [i / CELLS for i in range(CELLS + 1)]
    cut = _inside(obs, keys, value, wide, rows).groupBy(*target).agg(
        F.count(F.lit(1)).alias("_c"), F.percentile_approx(value, grid, ACCURACY).alias("_e"))
    # Edge i has a rank within a tenth of a cell of i cells, so one whole cell is room enough.
    place = [(F.col(rank) - F.col("_below")) * F.lit(CELLS) / F.col("_c")
             for rank in ("_first", "_last")]
    low, high = F.floor(place[0]) - 1, F.ceil(place[1]) + 2
    closer = materialise(cut.select(
        *keys, "_n", "_below", "_first", "_last",
        F.when(low < 0, F.col("_lo")).otherwise(F.get("_e", low.cast("int"))).alias("_lo"),
        F.when(high > CELLS, F.col("_hi")).otherwise(F.get("_e", high.cast("int"))).alias("_hi"),
        F.col("_lo").alias("_from"), F.col("_hi").alias("_to")))
    joined = lookup_join(obs, closer, keys, rows, how="inner", weight="_n").filter(
        F.col(value).between(F.col("_from"), F.col("_hi")))
    inside = F.col(value) >= F.col("_lo")
    return joined.groupBy(*keys, "_n", "_lo", "_hi", "_first", "_last").agg(
        F.approx_count_distinct(F.when(inside, F.col(value))).alias("_d"),
        F.count_if(inside).alias("_inside"),
        (F.max("_below") + F.count_if(~inside)).alias("_below"))


# --- medians -----------------------------------------------------------------------------------

def observations(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (keys, column, value) of the non-null values of several double columns."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "column", "value").filter(
        F.col("value").isNotNull())


def _middle() -> Column:
    """Halves are added, so that no difference of two large values overflows."""
    return F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.col("low") / 2 + F.col("high") / 2)


def middle_of() -> Column:
    """``median`` from ``low`` and ``high``."""
    return _middle().alias("median")


def exact_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  limit: int = RANKED_VALUES) -> DataFrame:
    """(keys, column, median, n) for every group and column with at least one value."""
    picked = select_ranks(observations(df, keys, columns), [*keys, "column"], "value",
                          middle_ranks, limit)
    return picked.select(*keys, "column", _middle().alias("median"), "n")


def medians_with_total(df: DataFrame, key: str, columns: Sequence[str],
                       limit: int = RANKED_VALUES) -> DataFrame:
    """(key, column, median, n) per group and, with a null key, over all rows, in the same scans.

    Every observation counts for its group and for the total.
    """
    scopes = F.explode(F.array(
        F.struct(F.lit(False).alias("_all"), F.col(key).alias("_key")),
        F.struct(F.lit(True).alias("_all"), F.lit("").alias("_key"))))
    obs = observations(df, [key], columns).select("column", "value", scopes.alias("_s")).select(
        "_s._all", "_s._key", "column", "value")
    picked = select_ranks(obs, ["_all", "_key", "column"], "value", middle_ranks, limit)
    return picked.select(F.when(~F.col("_all"), F.col("_key")).alias(key), "column",
                         _middle().alias("median"), "n")


def widen(long: DataFrame, keys: Sequence[str], columns: Sequence[str],
          *extra: Column) -> DataFrame:
    """One column per entry of ``columns``; the list is fixed, so no extra job looks it up."""
    picked = [F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in columns]
    return long.groupBy(*keys).agg(*picked, *extra)


# --- boundaries --------------------------------------------------------------------------------

def rank_boundary(df: DataFrame, order: Sequence[str], wanted: Callable[[Column], Column],
                  by: Sequence[str] = (), limit: int = RANKED_VALUES) -> tuple[Kept, int]:
    """The tuple of ``order`` values that ends the first ``wanted(n)`` rows of each group.

    The ``order`` columns are whole numbers or zone-less time stamps, together unique within a
    group. Groups with ``wanted(n)`` = 0 have no row in the result. Returns a table with ``by``
    and ``_b0, _b1, ...`` (among others), and the number of groups. The first column is searched
    over all rows, each later one only among the rows that tie on the columns before it.
    """
    keys = list(by) or ["_all"]
    numeric = [f"_o{i}" for i in range(len(order))]
    base = df.select(
        *([_present(c, F.col(c)).alias(c) for c in by] or [F.lit(1).alias("_all")]),
        *[_present(c, _as_number(df, c)).alias(o) for c, o in zip(order, numeric)])
    sizes = materialise(group_sizes(base, keys, numeric[0]))
    groups, widest = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("_d"), F.lit(0))).first()
    rule = _wanted_rule(wanted)
    picked = (rank_counted(value_counts(base, keys, numeric[0]), keys, numeric[0], rule)
              if widest <= limit else
              _select_by_narrowing(base, keys, numeric[0], rule, sizes, limit))
    need = wanted(F.col("n")).cast("bigint") - F.col("below")
    known = keep(picked.filter(wanted(F.col("n")) > 0).select(
        *keys, "n", F.col("low").alias("_b0"), need.alias("_need"),
        F.col("equal").alias("_ties")), groups)
    for i, column in enumerate(numeric[1:], 1):
        found = [f"_b{j}" for j in range(i)]
        ties = lookup_join(base, known.table, keys, groups, how="inner", weight="_ties")
        for o, bound in zip(numeric, found):
            ties = ties.filter(F.col(o) == F.col(bound))
        # What is known of a group travels as keys: it is constant within the group.
        scope_keys = [*keys, "_need", *found]
        scope = ties.select(*scope_keys, column)
        most = (known.table.agg(F.max("_ties")).first()[0] if known.rows is None
                else max((row["_ties"] for row in known.rows), default=0)) or 0
        picked = (rank_counted(value_counts(scope, scope_keys, column), scope_keys, column,
                               _need_rule) if most <= limit
                  else select_ranks(scope, scope_keys, column, _need_rule, limit))
        sized = lookup_join(picked.drop("n"), known.table.select(*keys, "n"), keys, groups, "inner")
        known = keep(sized.select(
            *keys, "n", *found, F.col("low").alias(f"_b{i}"),
            (F.col("_need") - F.col("below")).alias("_need"), F.col("equal").alias("_ties")),
            groups)
    return known, groups


def _wanted_rule(wanted: Callable[[Column], Column]) -> RankRule:
    def rule(n: Column) -> Sequence[Column]:
        rank = F.greatest(wanted(n).cast("bigint") - 1, F.lit(0))
        return rank, rank
    return rule


def _need_rule(n: Column) -> Sequence[Column]:
    rank = F.col("_need") - 1
    return rank, rank


def _present(name: str, value: Column) -> Column:
    """A null has no rank: it is an error rather than a row that silently joins neither side."""
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit(f"{name} contains null values")))


def _as_number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return micros(F.col(name)) if kind == "timestamp_ntz" else F.col(name).cast("bigint")


def within_boundary(df: DataFrame, order: Sequence[str], bound: Sequence[Column]) -> Column:
    """True for rows whose ``order`` tuple is not above the boundary tuple."""
    test = None
    for name, limit in reversed(list(zip(order, bound))):
        value = _as_number(df, name)
        test = value <= limit if test is None else (value < limit) | ((value == limit) & test)
    return test
