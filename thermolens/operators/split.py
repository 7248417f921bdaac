"""Train/test splits. Each ends as a filter, so nothing is sorted or ranked at split time."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolens.functions.labels import wall_clock
from thermolens.functions.numeric import hash_bucket, hash_key
from thermolens.operators.order_stats import RANKED_VALUES, rank_boundary, within_boundary
from thermolens.schema import ID, TARGET, TIME
from thermolens.session import lookup_join

DEFAULT_CUTOFF = "2025-10-01"
_EPOCH = datetime(1970, 1, 1)


def cutoff_condition(df: DataFrame, cutoff: str, column: str = TIME) -> Column:
    """True for rows before the ISO date or time; reaches the scan when the column is parsed."""
    datetime.fromisoformat(cutoff)
    parsed = dict(df.dtypes)[column] == "timestamp_ntz"
    when = F.col(column) if parsed else wall_clock(column)
    return when < F.lit(cutoff).cast("timestamp_ntz")


def split_by_cutoff(df: DataFrame, cutoff: str = DEFAULT_CUTOFF, column: str = TIME, *,
                    check: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff, and rows at or after it.

    A row without a time that can be read belongs to neither side; reading the second one raises.
    With ``check`` a single pass rejects such rows, and empty sides, beforehand.
    """
    date.fromisoformat(cutoff)
    before = cutoff_condition(df, cutoff, column)
    if check:
        n = df.agg(F.count_if(before).alias("train"), F.count_if(~before).alias("test"),
                   F.count_if(before.isNull()).alias("bad")).first()
        if n["bad"]:
            raise ValueError(f"{column} contains invalid time stamps")
        if not n["train"] or not n["test"]:
            raise ValueError("Train or test split is empty; check the cutoff and the input dates")
    # The scan still gets a range, or null, to prune by; then a null is an error.
    rest = df.filter(~before | before.isNull()).filter(F.when(before.isNotNull(), True).otherwise(
        F.raise_error(F.lit(f"{column} contains invalid time stamps")).cast("boolean")))
    return df.filter(before), rest


def rank_conditions(df: DataFrame, first: float | int, order: tuple[str, ...] = (TIME, ID),
                    limit: int = RANKED_VALUES) -> tuple[Column, Column]:
    """Tests for the first share (float) or number (int) of rows in ``order``, and for the rest.

    The boundary row is found once by counting; the tests compare raw columns with its values.
    Each test bounds the leading column on its own, so that this part reaches the scan.
    """
    if isinstance(first, float):
        wanted = lambda n: F.floor(n * F.lit(first))
    else:
        wanted = lambda n: F.least(n, F.lit(first))
    known, _ = rank_boundary(df, order, wanted, limit=limit)
    if not known.rows:
        return F.lit(False), F.lit(True)
    kinds, inside, outside = dict(df.dtypes), None, None
    for i, name in reversed(list(enumerate(order))):
        column, value = F.col(name), _literal(known.rows[0][f"_b{i}"], kinds[name])
        inside = (column <= value if inside is None
                  else (column <= value) & ((column < value) | inside))
        outside = (column > value if outside is None
                   else (column >= value) & ((column > value) | outside))
    return inside, outside


def _literal(number: int, kind: str) -> Column:
    if kind == "timestamp_ntz":
        return F.lit((_EPOCH + timedelta(microseconds=number)).isoformat(" ")).cast(kind)
    return F.lit(number).cast(kind)


def split_by_rank(df: DataFrame, share: float = 0.8, order: tuple[str, ...] = (TIME, ID),
                  limit: int = RANKED_VALUES) -> tuple[DataFrame, DataFrame]:
    """The earliest ``floor(share * n)`` rows, and the rest; ties in time are cut by id."""
    inside, outside = rank_conditions(df, float(share), order, limit)
    return df.filter(inside), df.filter(outside)


def first_rows(df: DataFrame, n: int, order: tuple[str, ...] = (TIME, ID),
               limit: int = RANKED_VALUES) -> DataFrame:
    """Exactly the first ``n`` rows in ``order``, without sorting or gathering them."""
    return df.filter(rank_conditions(df, int(n), order, limit)[0])


def add_stratified_split(df: DataFrame, share: float = 0.8, label: str = TARGET, key: str = ID,
                         limit: int = RANKED_VALUES) -> DataFrame:
    """Adds ``split``: ``floor(share * n)`` pseudo-random rows of every class are ``train``.

    Classes may be of any size: the boundary (hash, id) of each class is found by counting.
    """
    hashed = df.withColumn("_hash", hash_key(key))
    order = ("_hash", key)
    bound, classes = rank_boundary(hashed, order, lambda n: F.floor(n * F.lit(share)), [label],
                                   limit)
    table = bound.table.select(label, "_b0", "_b1", F.col("n").alias("_rows"))
    joined = lookup_join(hashed, table, [label], classes, weight="_rows")
    inside = within_boundary(hashed, order, [F.col("_b0"), F.col("_b1")])
    split = F.when(F.coalesce(inside, F.lit(False)), "train").otherwise("test")
    return joined.withColumn("split", split).select(*df.columns, "split")


def hash_sample(df: DataFrame, share: float = 0.15, key: str = ID) -> DataFrame:
    """A repeatable Bernoulli-like sample: the same ids whatever the partitioning."""
    return df.filter(_in_share(share, key))


def _in_share(share: float, key: str) -> Column:
    """Whether an id falls into the first of 10,000 buckets; a null id is an error."""
    bucket = hash_bucket(key, 10_000)
    return F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{key} contains null values"))
                  .cast("boolean")).otherwise(bucket < round(share * 10_000))


def hash_split(df: DataFrame, share: float = 0.8, key: str = ID) -> tuple[DataFrame, DataFrame]:
    inside = _in_share(share, key)
    return df.filter(inside), df.filter(~inside)


def random_split(df: DataFrame, share: float = 0.8, seed: int = 42) -> list[DataFrame]:
    """Spark's own split; rows may move between sides when partitioning changes."""
    return df.randomSplit([share, 1 - share], seed=seed)


def bernoulli_sample(df: DataFrame, share: float = 0.15, seed: int = 42) -> DataFrame:
    return df.sample(fraction=share, seed=seed)
