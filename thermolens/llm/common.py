"""Small helpers shared by the operators: settled tables and skew-safe lookups."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from thermolens.session import scratch_path

HOT_KEYS = 1000


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage cut, columns prunable."""
    return df.sparkSession.read.parquet(settled_path(df, name))


def settled_path(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def whole_text(name: str = "text") -> Column:
    """The text as a string, null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def steady(docs: DataFrame) -> DataFrame:
    """``docs`` itself if its rows come straight from files, else a written copy.

    Operators that number the rows of a table in more than one job need this: behind a shuffle, a
    limit or a cache, rows may come in another order each time, and numbers would not agree.
    """
    plan = io.StringIO()
    with redirect_stdout(plan):
        docs.explain()
    text = plan.getvalue()
    if "FileScan" in text and not any(
            x in text for x in ("Exchange", "InMemoryTableScan", "ExistingRDD", "Limit")):
        return docs
    return settle(docs, "input")


def row_id(docs: DataFrame) -> Column:
    """A number that tells rows of a scan apart, the same whenever the scan is repeated.

    It depends on how files are split, which for small inputs would follow the number of executors
    present; so that a lost executor changes nothing, that number is pinned for the session.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.files.minPartitionNum"
    if conf.get(key, None) is None:
        conf.set(key, str(docs.sparkSession.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def with_row(docs: DataFrame, *columns: str, row: str = "row") -> DataFrame:
    """The named columns and the number of each row."""
    return docs.select(*columns, row_id(docs).alias(row))


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Left join with a table of one row per key that says in ``weight`` how many rows have it.

    A key with more than 1/HOT_KEYS of all rows is broadcast, so at most HOT_KEYS table rows are;
    the others are shuffled, and none of them has more than that share.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    hot = table.filter(F.col(weight) * HOT_KEYS > F.lit(total))
    cold = table.filter(F.col(weight) * HOT_KEYS <= F.lit(total))
    return (rows.join(F.broadcast(hot), key)
            .unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti")
                         .join(cold, key, "left")))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
