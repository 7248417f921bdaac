"""Suffix-array dedup: removal of long repeated passages by a logarithmic family of indexes.

The arrays are sparse. Of every window of LENGTH bytes the suffix that starts at the window's
anchor is entered - the place whose next GRAM bytes hash lowest - so equal windows enter equal
suffixes, and one suffix stands for a run of windows. Suffixes are ordered by the hash of their
first GRAM bytes, which brings equal ones together as an order by content would.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermolens.llm.common import (
    lookup, partitions, row_id, settle, settled_path, steady, whole_text, with_row)
from thermolens.llm.shingles import BYTE_CODES, mix, powers

LENGTH, GRAM = 200, 100
_PLACE = np.uint64((1 << 20) - 1)
STEP = (1 << 20) - LENGTH
#: Bits of a filter (16 MB at most, whatever the table's size).
FILTER_BITS = 27
#: A suffix with more different surroundings than this is compared window by window.
HOT_SUFFIX = 4096
#: Suffixes or windows handled at a time.
AT_ONCE = 1 << 20


def _grams(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash of the bytes at each place and the following ones, ``size`` in all."""
    up, down = powers(raw.size + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[0][raw] * up[:raw.size])))
    return mix((sums[size:] - sums[:-size]) * down[:raw.size - size + 1])


def anchors(raw: np.ndarray) -> np.ndarray:
    """Per run of windows with one anchor: gram, start, windows and digest of the run's bytes, as
    the rows of an array of 64-bit numbers."""
    found = [np.empty((4, 0), np.uint64)]
    for k in range(0, raw.size - LENGTH + 1, STEP):
        part = raw[k:k + STEP + LENGTH - 1]
        grams = _grams(part, GRAM)
        # The low bits of a key are its place, so the least key also tells where it stands.
        least = grams & ~_PLACE | np.arange(grams.size, dtype=np.uint64)
        size, width = 1, LENGTH - GRAM + 1
        while size < width:
            by = min(size, width - size)
            least = np.minimum(least[:-by], least[by:])
            size += by
        at = least & _PLACE
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        windows = np.diff(np.concatenate((starts, [at.size])))
        up, down = powers(part.size + 1)
        sums = np.concatenate((np.zeros(1, np.uint64),
                               np.cumsum(BYTE_CODES[1][part] * up[:part.size])))
        run = (sums[starts + windows + LENGTH - 1] - sums[starts]) * down[starts]
        # The least of many hashes is small; mixed again, suffixes spread evenly over the order.
        found.append(np.stack((mix(grams[at[starts].astype(np.int64)]),
                               (starts + k).astype(np.uint64), windows.astype(np.uint64),
                               mix(run + windows.astype(np.uint64)))))
    return np.concatenate(found, 1)


def _bytes_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for row, text in zip(batch["row"].to_pylist(), batch["text"]):
        yield row, np.frombuffer(text.as_py().encode(), np.uint8)


class SuffixIndex:
    """Levels of sorted suffixes, each a table with one packed run per bucket (a range of the
    order). A new batch gets its arrays, which are merged bucket by bucket with those of the levels
    to find suffixes that were there before; levels of equal size are merged into the new one, so
    n batches leave at most log2(n) + 1 levels. Of equal suffixes one is kept, so a hot passage
    adds no more to a bucket than any other."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets = spark, buckets
        self.levels: list[tuple[int, str]] = []
        self.repeats: list[str] = []

    def add(self, docs: DataFrame) -> None:
        """Enter a batch (row, text) and note which of its suffixes repeat."""
        rank, merged, kept = 0, [], []
        for size, path in sorted(self.levels):
            if size == rank:
                merged.append(path)
                rank += 1
            else:
                kept.append((size, path))
        edges = np.array([(i << 64) // self.buckets for i in range(1, self.buckets)], np.uint64)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def runs(found: list[np.ndarray]) -> pa.RecordBatch:
                grams, seen = np.unique(np.concatenate(found), return_counts=True)
                parts = np.split(grams, np.searchsorted(grams, edges))
                twice = grams[seen > 1]
                repeated = np.split(twice, np.searchsorted(twice, edges))
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(parts), dtype=np.int32)),
                     pa.array([-1] * len(parts), pa.int32()),
                     pa.array([p.tobytes() for p in parts], pa.binary()),
                     pa.array([p.tobytes() for p in repeated], pa.binary())],
                    ["bucket", "level", "grams", "repeated"])

            found, size = [], 0
            for batch in batches:
                for _, raw in _bytes_of(batch):
                    if raw.size >= LENGTH:
                        found.append(anchors(raw)[0])
                        size += found[-1].size
                    if size >= AT_ONCE:
                        yield runs(found)
                        found, size = [], 0
            if found:
                yield runs(found)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def scan(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
                empty = np.empty(0, np.uint64)
                fresh, seen = np.unique(np.concatenate(
                    [empty, *(g for level, g, _ in rows if level < 0)]), return_counts=True)
                repeated = [fresh[seen > 1], *(t for level, _, t in rows if level < 0)]
                result = [fresh]
                for level, grams, _ in rows:
                    if level < 0 or not grams.size:
                        continue
                    at = np.minimum(np.searchsorted(grams, fresh), grams.size - 1)
                    repeated.append(fresh[grams[at] == fresh])
                    if level < len(merged):
                        result.append(grams)
                return pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()),
                     pa.array([np.unique(np.concatenate(result)).tobytes()], pa.binary()),
                     pa.array([np.unique(np.concatenate(repeated)).tobytes()], pa.binary())],
                    ["bucket", "grams", "repeated"])

            last, rows = None, []
            for batch in batches:
                for r in range(len(batch)):
                    bucket = batch["bucket"][r].as_py()
                    if bucket != last and rows:
                        yield scan(last, rows)
                        rows = []
                    last = bucket
                    rows.append((batch["level"][r].as_py(), *(
                        np.frombuffer(batch[c][r].as_py(), np.uint64)
                        for c in ("grams", "repeated"))))
            if rows:
                yield scan(last, rows)

        rows = docs.mapInArrow(cut, "bucket int, level int, grams binary, repeated binary")
        for i, path in enumerate([*merged, *(path for _, path in kept)]):
            rows = rows.union(self.spark.read.parquet(path).select(
                "bucket", F.lit(i).alias("level"), "grams", F.lit(b"").alias("repeated")))
        path = settled_path(
            rows.repartition(self.buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
                merge, "bucket int, grams binary, repeated binary"), "level")
        self.levels = [*kept, (rank, path)]
        self.repeats.append(path)

    def repeated(self) -> DataFrame:
        """Packed suffixes that were met more than once."""
        return self.spark.read.parquet(*self.repeats).select("repeated")


class Filter:
    """A Bloom filter of fixed size with one hash function: what it lets through may be wrong, what
    it stops is not. It only saves shuffling; the joins that follow decide."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - FILTER_BITS)
        return self.words[(place >> np.uint64(6)).astype(np.int64)] >> (
            place & np.uint64(63)) & np.uint64(1) == 1

    @staticmethod
    def of(rows: DataFrame, hashes) -> Filter:
        """``hashes`` gives the 64-bit hashes of an Arrow batch of ``rows``. Tasks send words of
        the bit map, whose number is bounded, and Spark joins them by OR."""
        def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = np.unique(hashes(batch) >> np.uint64(64 - FILTER_BITS))
                words, first = np.unique(place >> np.uint64(6), return_index=True)
                mask = np.uint64(1) << (place & np.uint64(63))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.astype(np.int64)),
                     pa.array((np.bitwise_or.reduceat(mask, first) if words.size else mask)
                              .view(np.int64))], ["word", "bits"])

        found = rows.mapInArrow(bits, "word long, bits long").groupBy("word").agg(
            F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(1 << FILTER_BITS - 6, np.uint64)
        words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return Filter(words)


def _runs_of(truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], truth, [False]))))
    return edge[::2], edge[1::2]


def _windows(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of the strings, with the string and place of each."""
    raw = np.frombuffer(b"".join(strings), np.uint8)
    size = np.array([len(s) for s in strings])
    count = size - LENGTH + 1
    owner = np.repeat(np.arange(size.size), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(np.cumsum(size) - size, count)
    return _grams(raw, LENGTH)[first + place], owner, place


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the windows found twice among the runs of a suffix; its runs come in a row."""
    def spans(rows: list[tuple]) -> pa.RecordBatch:
        hashes, owner, place = _windows([r[2] for r in rows])
        _, at, seen = np.unique(hashes, return_inverse=True, return_counts=True)
        twice = seen[at] > 1
        begins = twice & ~(np.concatenate(([False], twice[:-1])) & (place > 0))
        ends = twice & ~np.concatenate((twice[1:] & (place[1:] > 0), [False]))
        i, j = np.flatnonzero(begins), np.flatnonzero(ends)
        docs, starts = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[owner[i]]), pa.array(starts[owner[i]] + place[i]),
             pa.array(starts[owner[j]] + place[j] + LENGTH)], ["row", "start", "end"])

    last, rows, size = None, [], 0
    for batch in batches:
        grams = batch["gram"].to_pylist()
        for gram, *row in zip(grams, batch["row"].to_pylist(), batch["start"].to_pylist(),
                              batch["run"].to_pylist()):
            if gram != last and size >= AT_ONCE:
                yield spans(rows)
                rows, size = [], 0
            last = gram
            rows.append(row)
            size += len(row[2])
    if rows:
        yield spans(rows)


def _each_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, len(batch), 1024):
            part = batch.slice(k, 1024)
            hashes, owner, place = _windows(part["run"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(part["row"].to_numpy()[owner]),
                 pa.array(part["start"].to_numpy()[owner] + place)], ["window", "row", "start"])


def _place_hash(row: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(mix(row.view(np.uint64)) + start.view(np.uint64))


def repeated_spans(docs: DataFrame, batches: int = 2) -> DataFrame:
    """row, start, end of stretches of bytes of ``docs`` (row, text) whose every window of LENGTH
    bytes also starts elsewhere; together they cover all such bytes, and they may overlap.

    1. Batches of documents enter a SuffixIndex, which says which suffixes repeat.
    2. The runs of windows around those are grouped by suffix and content. A run found twice is
       repeated as a whole.
    3. The other runs, with one example of each repeated one, are compared by window with all
       runs of their suffix; a suffix with more than HOT_SUFFIX different runs is compared by
       hashed windows, spread over all tasks.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    index = SuffixIndex(spark, parts)
    for i in range(batches):
        index.add(docs.filter(F.pmod(F.xxhash64("row"), F.lit(batches)) == i))
    suffixes = spark.sparkContext.broadcast(Filter.of(index.repeated(), lambda b: np.concatenate(
        [np.empty(0, np.uint64), *(np.frombuffer(x, np.uint64)
                                   for x in b["repeated"].to_pylist())])).words)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = Filter(suffixes.value)
        for batch in batches:
            rows, found = [], [np.empty((4, 0), np.uint64)]
            for row, raw in _bytes_of(batch):
                if raw.size >= LENGTH:
                    own = anchors(raw)
                    own = own[:, may.has(own[0])]
                    rows.append(np.full(own.shape[1], row))
                    found.append(own)
            gram, start, windows, digest = np.concatenate(found, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(digest.view(np.int64)),
                 pa.array(np.concatenate([np.empty(0, np.int64), *rows])),
                 pa.array(start.view(np.int64)), pa.array(windows.astype(np.int32))],
                ["gram", "digest", "row", "start", "windows"])

    runs = settle(docs.mapInArrow(
        candidates, "gram long, digest long, row long, start long, windows int"), "runs")
    kinds = settle(runs.groupBy("gram", "digest").agg(
        F.count(F.lit(1)).alias("weight"), F.min(F.struct("row", "start")).alias("one")), "kinds")
    mixed = kinds.groupBy("gram").agg(
        F.count(F.lit(1)).alias("kinds"), F.min("weight").alias("least")).filter(
        "kinds > 1 and least = 1")
    asked = settle(kinds.join(mixed, "gram").select(
        "one.row", "one.start", (F.col("kinds") > HOT_SUFFIX).alias("hot")), "asked")
    key = F.struct("gram", "digest")
    whole = lookup(runs.select(key.alias("key"), "row", "start", "windows"),
                   kinds.filter("weight > 1").select(key.alias("key"), "weight"), "key",
                   "weight").filter("weight is not null").select(
        "row", "start", (F.col("start") + F.col("windows") + (LENGTH - 1)).alias("end"))

    places = spark.sparkContext.broadcast(Filter.of(asked.select("row", "start"), lambda b: (
        _place_hash(b["row"].to_numpy(), b["start"].to_numpy()))).words)

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may, may_ask = Filter(suffixes.value), Filter(places.value)
        for batch in batches:
            out = []
            for row, raw in _bytes_of(batch):
                if raw.size >= LENGTH:
                    own = anchors(raw)
                    own = own[:, may.has(own[0])]
                    own = own[:, may_ask.has(_place_hash(
                        np.full(own.shape[1], row), own[1].view(np.int64)))]
                    out += [(gram, row, start, raw[start:start + n + LENGTH - 1].tobytes())
                            for gram, start, n in own[:3].view(np.int64).T.tolist()]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]),
                 pa.array(columns[3], pa.binary())], ["gram", "row", "start", "run"])

    shown = settle(docs.mapInArrow(contents, "gram long, row long, start long, run binary")
                   .join(asked, ["row", "start"]), "shown")
    some = (shown.filter("not hot").select("gram", "row", "start", "run")
            .repartition(parts, "gram").sortWithinPartitions("gram")
            .mapInArrow(_compare, "row long, start long, end long"))
    windows = shown.filter("hot").select("row", "start", "run").mapInArrow(
        _each_window, "window long, row long, start long")
    seen = windows.groupBy("window").agg(F.count(F.lit(1)).alias("weight")).filter("weight > 1")
    hot = lookup(windows, seen, "window", "weight").filter("weight is not null").select(
        "row", "start", (F.col("start") + LENGTH).alias("end"))
    return whole.union(some).union(hot)


def _remove(raw: pd.Series, spans: pd.Series) -> pd.DataFrame:
    kept, removed, number = [], [], []
    for text, own in zip(raw, spans):
        if own is None:
            kept.append(None)
            removed.append(0)
            number.append(0)
            continue
        pairs = np.asarray(own).reshape(-1, 2)
        depth = np.zeros(len(text) + 1, np.int32)
        np.add.at(depth, pairs[:, 0], 1)
        np.add.at(depth, pairs[:, 1], -1)
        covered = np.cumsum(depth[:-1]) > 0
        kept.append(np.frombuffer(text, np.uint8)[~covered].tobytes())
        removed.append(int(covered.sum()))
        number.append(_runs_of(covered)[0].size)
    return pd.DataFrame({"kept": kept, "n_removed": removed, "n_spans": number})


def remove_repeats(docs: DataFrame, batches: int = 2, name: str = "cut") -> DataFrame:
    """All columns of ``docs`` and a struct ``name``: kept (the remaining bytes), n_removed, n_spans
    (maximal removed stretches) of each text.

    A byte goes if it lies in a string of LENGTH bytes that also starts elsewhere, in another or
    the same text, overlaps included; all copies go, the first too. Texts are judged as they came,
    not by what is left, and matches never cross documents. Strings are compared by 64-bit hashes.

    A null text counts as empty, and texts under LENGTH bytes lose nothing; repeated rows are
    copies of each other; an empty table gives no rows; other columns pass through, and one called
    ``name`` is replaced. Rows that do not come straight from files are written first, as they are
    read several times.
    """
    docs = steady(docs)
    numbered = with_row(docs.select(whole_text().alias("text")), "text")
    spans = repeated_spans(numbered, batches).groupBy("row").agg(
        F.collect_list(F.array("start", "end")).alias("spans"))
    mark, found = f"row_{uuid.uuid4().hex}", f"spans_{uuid.uuid4().hex}"
    told = docs.withColumn(mark, row_id(docs)).join(
        spans.select(F.col("row").alias(mark), F.flatten("spans").alias(found)),
        mark, "left")
    raw = whole_text().cast("binary")
    remove = F.pandas_udf(_remove, "kept binary, n_removed long, n_spans long")
    told = told.withColumn(name, remove(raw, F.col(found)))
    return told.withColumn(name, F.struct(
        F.coalesce(F.col(f"{name}.kept"), raw).alias("kept"), F.col(f"{name}.n_removed"),
        F.col(f"{name}.n_spans"))).drop(mark, found)


def cut_texts(docs: DataFrame, batches: int = 2) -> DataFrame:
    """``docs`` with shortened texts and, if there is such a column, their n_chars.

    Where a removed stretch ends within a character, the rest of the character goes too. Texts that
    lose nothing, nulls among them, stay as they are; none of the rows is dropped.
    """
    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: None if b is None else b.decode(errors="ignore"))

    cut = f"cut_{uuid.uuid4().hex}"
    told = remove_repeats(docs, batches, cut)
    changed = F.col(f"{cut}.n_removed") > 0
    text = F.when(changed, decoded(F.when(changed, F.col(f"{cut}.kept")))).otherwise(
        F.col("text").cast("string"))
    told = told.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        told = told.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(
            F.col("n_chars")))
    return told.select(*docs.columns)
