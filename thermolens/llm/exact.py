"""Exact dedup: a persistent digest index, bucketed and sorted by hash."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermolens.llm.common import lookup, partitions, row_id, settle, steady, whole_text
from thermolens.session import scratch_path

#: Characters that do not count when texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
#: Digests that a bucket is meant to hold: some 50 MB.
BUCKET_ROWS = 1_000_000


class DigestIndex:
    """Digests of all texts seen so far, in files bucketed and sorted by digest at ``path``.

    ``dedup`` compares a batch with the index and with itself by sort-merge joins on the digest,
    appends the new digests, and returns one row per row of the batch: doc_id, keep_id,
    group_size (rows of this batch with the text), kept, text_sha256. Other columns are not read.

    Of equal texts the longest original stays, then the smallest doc_id; a text already in the
    index keeps its earlier document and nothing of the batch stays. A null text is empty, all
    empty texts are one group, a null doc_id comes last, and of repeated rows (same doc_id, same
    text) one stays. An empty table gives an empty result.

    Digests carry the name of their batch. What a batch of the same name left behind does not count
    as known and is not entered again, so a run that broke off can be repeated with its name and
    decides as if it were the first. Without a name every call is a batch of its own.

    The path may hold an earlier index. The number of buckets is chosen when an index is begun
    (``expected`` rows, BUCKET_ROWS a bucket, and no fewer buckets than shuffle partitions) and
    kept beside it; another number is refused.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None,
                 expected: int = 0) -> None:
        self.spark, self.path = spark, path
        layout = f"{path}-layout"
        try:
            self.buckets = spark.read.schema("buckets int").json(layout).first()["buckets"]
        except AnalysisException:  # nothing there yet
            self.buckets = buckets or max(partitions(spark), -(-expected // BUCKET_ROWS))
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.json(layout)
        if buckets not in (None, self.buckets):
            raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")

    @contextmanager
    def opened(self) -> Iterator[str]:
        """The name of a table over the files, for as long as a batch needs it."""
        table = f"digest_index_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")
        try:
            yield table
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay

    def _judge(self, docs: DataFrame, row: str, batch: str | None) -> DataFrame:
        """doc_id, digest, n_chars and row of every document, with its group's decision."""
        batch = batch or uuid.uuid4().hex
        rows = settle(docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.unhex(F.sha2(F.regexp_replace(whole_text(), BLANKS, ""), 256)).alias("digest"),
            F.length(whole_text()).alias("n_chars"), F.col(row).alias("row")), "digests")
        best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row"))
        groups = rows.groupBy("digest").agg(
            F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        with self.opened() as table:
            entered = self.spark.table(table)
            known = entered.filter(F.col("batch") != batch).select(
                "digest", F.col("keep_id").alias("known_id"), F.lit(True).alias("known"))
            judged = settle(groups.hint("merge").join(known, "digest", "left").select(
                "digest", "group_size",
                F.when(F.col("known"), F.col("known_id")).otherwise(F.col("best.doc_id"))
                .alias("keep_id"),
                F.when(F.col("known").isNull(), F.col("best.row")).alias("keep_row")), "groups")
            # What the anti-join with the index leaves is new, and is appended bucket by bucket.
            fresh = judged.hint("merge").join(entered.select("digest"), "digest", "left_anti")
            fresh.select("digest", "keep_id", F.lit(batch).alias("batch")).write.insertInto(table)
        return lookup(rows, judged, "digest", "group_size").withColumn(
            "kept", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)))

    def dedup(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        mark = f"row_{uuid.uuid4().hex}"
        numbered = docs.select("doc_id", "text", row_id(docs).alias(mark))
        return self._judge(numbered, mark, batch).select(
            "doc_id", "keep_id", "group_size", "kept",
            F.lower(F.hex("digest")).alias("text_sha256"))

    def keep(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns: one of each text that no earlier
        batch held, chosen as by ``dedup``. Nulls, ties, repeated rows and empty tables as there.
        Rows that do not come straight from files are written first, as they are read twice."""
        mark = f"row_{uuid.uuid4().hex}"
        docs = steady(docs)
        numbered = docs.withColumn(mark, row_id(docs))
        kept = self._judge(numbered, mark, batch).filter("kept").select(F.col("row").alias(mark))
        return numbered.join(kept, mark, "left_semi").drop(mark)


def fresh_index(spark: SparkSession, docs: DataFrame | None = None) -> DigestIndex:
    """An empty index in the shared folder, with buckets for the rows of ``docs``."""
    return DigestIndex(spark, scratch_path(spark, "digest-index"),
                       expected=docs.count() if docs is not None else 0)
