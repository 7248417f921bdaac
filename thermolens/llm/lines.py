"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from thermolens.llm.common import lookup, row_id, settle
from thermolens.llm.urls import split_url


#: What lines are trimmed of: the white space of ASCII.
BLANKS = " \t\n\x0b\x0c\r"


def page_lines(html: Column) -> Column:
    """The text lines of a page: what stands between tags, trimmed, without scripts and styles."""
    text = F.coalesce(html.cast("string"), F.lit(""))
    text = F.regexp_replace(text, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "\n")
    return F.filter(F.transform(F.split(text, r"\n"), lambda line: F.trim(line, F.lit(BLANKS))),
                    lambda line: line != "")


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def drop_boilerplate(pages: DataFrame, ratio: float = 0.3, least: int = 5) -> DataFrame:
    """page_id, host, n_lines, n_dropped and kept (the remaining lines, joined by line ends).

    Pages are grouped by the host of their url. A line goes from all pages of a host if more than
    ``ratio`` of the host's pages contain it; a host with fewer than ``least`` pages loses nothing.

    Lines are counted once per page, by digest, and pre-aggregated per task, so a hot host or line
    costs no more than others; lines over the ratio are at most 1/ratio times the lines of a page,
    per host. Null html has no lines, a null url or one without a host belongs to the empty host;
    repeated rows are pages each; an empty table gives no rows; other columns are not read.
    """
    host, _ = split_url(F.col("url"))
    numbered = pages.select(
        "page_id", host.alias("host"), page_lines(F.col("html")).alias("lines"),
        row_id(pages).alias("row"))
    each = numbered.select("row", "host", F.explode(F.array_distinct("lines")).alias("line")).select(
        "row", "host", _digest(F.col("line")).alias("digest"))
    seen = each.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("weight"))
    totals = numbered.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    common = settle(seen.join(totals, "host").filter(
        (F.col("pages") >= least) & (F.col("weight") > F.col("pages") * F.lit(ratio))).select(
        F.struct("host", "digest").alias("key"), "weight"), "boilerplate")
    hits = lookup(each.select("row", "digest", F.struct("host", "digest").alias("key")), common,
                  "key", "weight").filter("weight is not null").groupBy("row").agg(
        F.collect_set("digest").alias("gone"))
    told = numbered.join(hits, "row", "left")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda line: ~F.array_contains("gone", _digest(line))))
    return told.withColumn("left", kept).select(
        "page_id", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_dropped"),
        F.array_join("left", "\n").alias("kept"))
