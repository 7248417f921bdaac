"""N-gram Jaccard join: a MinHash LSH forest followed by exact verification."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermolens.llm.batches import by_bytes
from thermolens.llm.common import lookup, partitions, row_id, settle, steady, whole_text, with_row
from thermolens.llm.components import components
from thermolens.llm.shingles import mix, shingles

TREES, LEVELS = 32, 8
#: Documents of a candidate group that are compared in one task, about; two such blocks meet.
BLOCK = 256
#: Cells of the matrix in which the sets of a block are intersected at a time.
CELLS = 1 << 24

_random = np.random.default_rng(3)
_TIMES = _random.integers(0, 1 << 32, TREES * LEVELS, np.uint32) | np.uint32(1)
_PLUS = _random.integers(0, 1 << 32, TREES * LEVELS, np.uint32)


def forest_labels(found: np.ndarray) -> np.ndarray:
    """One label per tree: a byte of each of its LEVELS MinHash values, the first one on top.

    Labels sorted as numbers are the leaves of a prefix trie in order.
    """
    low = found.astype(np.uint32)
    least = np.full(TREES * LEVELS, 0xFFFFFFFF, np.uint32)
    for k in range(0, low.size, 1024):
        part = low[k:k + 1024, None] * _TIMES + _PLUS
        np.minimum(least, part.min(0), out=least)
    byte = (mix(least.astype(np.uint64)) & np.uint64(255)).reshape(TREES, LEVELS)
    label = np.zeros(TREES, np.uint64)
    for level in range(LEVELS):
        label = label << np.uint64(8) | byte[:, level]
    return label.view(np.int64)


def prefix_depth(threshold: float, target: float) -> int:
    """The longest prefix that finds a pair at the threshold with the target probability.

    Matched prefixes start at full length and are shortened until some tree puts such a pair under
    one prefix often enough; a more similar pair is found more often still.
    """
    depth = LEVELS
    while depth > 1 and 1 - (1 - threshold ** depth) ** TREES < target:
        depth -= 1
    return depth


def features(docs: DataFrame) -> DataFrame:
    """row, doc_id, copy (digest of the set of shingles, null without words), labels (packed)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in by_bytes(b, "text", 1 << 20)):
            copies, labels = [], []
            for text in part["text"]:
                found = shingles(text.as_py())
                copies.append(hashlib.md5(found.tobytes()).digest() if found.size else None)
                labels.append(forest_labels(found).tobytes() if found.size else None)
            yield pa.RecordBatch.from_arrays(
                [part["row"], part["doc_id"], pa.array(copies, pa.binary()),
                 pa.array(labels, pa.binary())], ["row", "doc_id", "copy", "labels"])

    return docs.mapInArrow(read, "row long, doc_id long, copy binary, labels binary")


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = len(batch)
        labels = np.frombuffer(b"".join(batch["labels"].to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch["row"].to_numpy(), TREES)),
             pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), pa.array(labels)],
            ["row", "tree", "label"])


def _links(sets: list[np.ndarray], blocks: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the sets have the Jaccard similarity, as a matrix of truth; with two blocks, only
    pairs across them."""
    n = len(sets)
    size = np.array([s.size for s in sets])
    owner = np.repeat(np.arange(n), size)
    found, local, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[local] > 1
    owner, local = owner[shared], local[shared]
    names, local = np.unique(local, return_inverse=True)
    both = np.zeros((n, n))
    order = np.argsort(local, kind="stable")
    owner, local = owner[order], local[order]
    width = max(1, CELLS // n)
    for k in range(0, names.size, width):
        low, high = np.searchsorted(local, (k, k + width))
        cells = np.zeros((n, min(width, names.size - k)), np.float32)
        cells[owner[low:high], local[low:high] - k] = 1
        both += cells @ cells.T
    linked = both / (size[:, None] + size - both) >= threshold
    np.fill_diagonal(linked, False)
    if blocks.min() != blocks.max():
        linked &= blocks[:, None] != blocks
    return linked


def _verify(threshold: float):
    """Rows of one pair of blocks come in a row; each document's links are counted, and a link to
    the smallest document it can be reached from is given, never the pairs themselves."""
    def finish(rows: list[tuple]) -> list[tuple]:
        ids = np.array([r[0] for r in rows])
        blocks = np.array([r[1] for r in rows])
        weight = np.array([r[2] for r in rows])
        linked = _links([np.frombuffer(r[3], np.uint64) for r in rows], blocks, threshold)
        root = np.arange(len(rows))
        while True:
            best = np.where(linked, root, len(rows)).min(1)
            new = np.minimum(root, best)
            new = np.minimum(new, new[new])
            if (new == root).all():
                break
            root = new
        counts, texts = linked @ weight, linked.sum(1)
        return [(int(ids[i]), int(ids[root[i]]), int(counts[i]), int(texts[i]))
                for i in range(len(rows)) if texts[i]]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def out(made: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*made)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              ["row", "root", "links", "texts"])

        for batch in batches:
            made = []
            data = [batch[c].to_pylist() for c in ("set", "first", "second", "row", "block",
                                                   "weight")]
            for i, (group, first, second, row, block, weight) in enumerate(zip(*data)):
                if (group, first, second) != key:
                    made += finish(rows) if len(rows) > 1 else []
                    key, rows = (group, first, second), []
                rows.append((row, block, weight, batch["shingles"][i].as_py()))
            yield out(made)
        yield out(finish(rows) if len(rows) > 1 else [])

    return verify


def near_duplicates(docs: DataFrame, threshold: float = 0.8, target: float = 0.9999) -> DataFrame:
    """Documents by the Jaccard similarity of their sets of five-word shingles.

    One row per document: row (its number in the scan), doc_id, class_id (smallest doc_id of the
    documents connected by links), copy_id (smallest doc_id of those with the same shingles),
    n_links (other documents at or over the threshold, copies included), keeper (whether it stays
    when one document of each class does: the smallest doc_id, nulls last, then the first row).

    Documents with equal shingles are one text from then on. Texts under one prefix of a tree of
    the forest are candidates; connected candidates form a set, whose texts are all compared by
    their exact shingles, in blocks of about BLOCK against each other, so a large set is spread
    over many tasks and pairs are counted where they are found, not listed. The depth of prefixes
    guarantees the target recall at the threshold.

    Words are runs of bytes without ASCII white space; a text of fewer than five words is one
    shingle. A null, empty or blank text has no shingles, no links and its own class. Repeated
    rows are copies. An empty table gives no rows; other columns are not read. Rows that do not come
    straight from files are written first, as they are read twice.
    """
    spark, docs = docs.sparkSession, steady(docs)
    numbered = with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                    whole_text().alias("text")), "doc_id", "text")
    seen = settle(features(numbered), "features")
    copies = settle(seen.filter("copy is not null").groupBy("copy").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("copy_id"),
        F.count(F.lit(1)).alias("weight"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")), "copies")
    shift = 8 * (LEVELS - prefix_depth(threshold, target))
    leaves = (seen.join(copies.select("row"), "row").select("row", "labels")
              .mapInArrow(_leaves, "row long, tree int, label long")
              .select("row", F.xxhash64("tree", F.shiftrightunsigned("label", shift))
                      .alias("prefix")))
    leaves = settle(leaves, "leaves")
    heads = leaves.groupBy("prefix").agg(F.min("row").alias("head"), F.count("*").alias("weight"))
    pairs = lookup(leaves, settle(heads.filter("weight > 1"), "heads"), "prefix", "weight").filter(
        "head <> row").select(F.col("head").alias("a"), F.col("row").alias("b"))
    sets = components(pairs).select(F.col("node").alias("row"), F.col("component").alias("set"))
    sizes = sets.groupBy("set").agg(F.count("*").alias("size"))
    members = (sets.join(sizes, "set").join(copies.select("row", "weight"), "row")
               .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
               .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
               .select("row", "set", "weight", "block", "blocks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text", 1 << 20):
                found = [shingles(t.as_py()).tobytes() for t in part["text"]]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in ("row", "set", "weight", "block", "blocks")),
                     pa.array(found, pa.binary())],
                    ["row", "set", "weight", "block", "blocks", "shingles"])

    met = (numbered.select("row", "text").join(members, "row").mapInArrow(
        cut, "row long, set long, weight long, block int, blocks int, shingles binary")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other")))
    parts = partitions(spark)
    verified = settle(
        met.repartition(parts, "set", "first", "second")
        .sortWithinPartitions("set", "first", "second", "row").mapInArrow(
            _verify(threshold), "row long, root long, links long, texts long"), "verified")
    counts = verified.groupBy("row").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("root").alias("a"), F.col("row").alias("b")))
    texts = (copies.join(classes.withColumnRenamed("node", "row"), "row", "left")
             .join(counts, "row", "left")
             .withColumn("component", F.coalesce("component", "row")))
    heads = texts.groupBy("component").agg(F.min("first").alias("head"),
                                           F.min("copy_id").alias("class_id"))
    told = settle(texts.join(heads, "component").select(
        "copy", "weight", "copy_id", "class_id", F.col("head.row").alias("keep_row"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "classes")
    columns = ["row", "doc_id", "class_id", "copy_id", "n_links", "keeper"]
    wordless = seen.filter("copy is null").select(
        "row", "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("keeper"))
    return lookup(seen.filter("copy is not null").select("row", "doc_id", "copy"), told, "copy",
                  "weight").withColumn("keeper", F.col("row") == F.col("keep_row")).select(
        columns).unionByName(wordless)


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class does, with all columns.

    Which one stays, nulls, ties, repeated rows and empty tables: see ``near_duplicates``. A text
    without words is its own class and stays.
    """
    mark, docs = f"row_{uuid.uuid4().hex}", steady(docs)
    kept = near_duplicates(docs, threshold).filter("keeper").select(F.col("row").alias(mark))
    return (docs.withColumn(mark, row_id(docs))
            .join(kept, mark, "left_semi").drop(mark))
