"""Packing along a space-filling curve."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermolens.llm.batches import by_bytes
from thermolens.llm.common import partitions, settle, whole_text, with_row
from thermolens.llm.tokens import encoder

HASHED, DIMENSIONS, BITS = 256, 3, 10
#: Parts of words that a task remembers, and bytes of text that it encodes at a time.
MEMORY, CHUNK = 1 << 19, 1 << 22
#: Keys that are sampled to cut the order into ranges.
SAMPLE = 100_000
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of points with whole coordinates below 2**bits.

    The coordinates are turned, bit plane by bit plane, into the Gray-coded index whose bits are
    read across the dimensions (Skilling's transform).
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & 1 << level, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[i] >> level & 1
    return key


class Projection:
    """Hashed document vectors of token counts, projected at random to a cell of the cube."""

    def __init__(self, ids: int, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        self.place = random.integers(0, HASHED, ids)
        self.sign = random.choice([-1.0, 1.0], ids)
        self.plane = random.standard_normal((HASHED, DIMENSIONS))

    def cells(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The cell of every document, given the ids of all and where each starts, with the end."""
        n = starts.size - 1
        document = np.repeat(np.arange(n) * HASHED, np.diff(starts))
        vectors = np.bincount(document + self.place[ids], self.sign[ids], n * HASHED)
        vectors = vectors.reshape(n, HASHED)
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        share = (1 + np.tanh(0.8 * (vectors @ self.plane) / np.where(length, length, 1.0))) / 2
        return np.minimum(share * (1 << BITS), (1 << BITS) - 1).astype(np.int64)


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """row, doc_id, n_tokens, ids (packed, with the end id) and the curve key of each document.

    The key's low bits are a hash of the row, so documents that share a cell are still spread.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, MEMORY)
        size = max(bpe.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        project = Projection(size)
        for batch in batches:
            for part in by_bytes(batch, "text", CHUNK):
                ids, starts = bpe.encode(part["text"])
                ids = np.insert(ids, starts[1:], end_id)
                starts = starts + np.arange(starts.size)
                key = hilbert_key(project.cells(ids, starts)) << 32 | part["spread"].to_numpy()
                packed = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(
                    (starts * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["doc_id"], pa.array(np.diff(starts)), pa.array(key),
                     packed], ["row", "doc_id", "n_tokens", "key", "ids"])
        bpe.forget()

    numbered = with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                    whole_text().alias("text")), "doc_id", "text")
    return numbered.withColumn("spread", F.xxhash64("row").bitwiseAND(0xFFFFFFFF)).mapInArrow(
        encode, "row long, doc_id long, n_tokens long, key long, ids binary")


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Sequences of ``length`` tokens from documents that are neighbours on a Hilbert curve.

    A document's ids end with ``end_id``. Its hashed token vector is projected to DIMENSIONS
    coordinates; documents are sorted by their place on the curve and laid end to end, cut where
    a sequence is full. So only the last sequence of the table can be short. Returns one row per
    piece (PIECES).

    Two numbers per document settle the layout: keys are cut into ranges of about as many tokens
    by SAMPLE of them, which only balances the work; each range's tokens are summed, and a range
    then knows where it starts. Ids are shuffled once, to the range of their document, where rows
    stream in sorted order.

    A null text is empty and gives just the end id; repeated rows are packed each; an empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = encoder(path, MEMORY).dtype
    rows = settle(encoded(docs, path, end_id), "encoded")
    ranges = partitions(spark)
    share = min(1.0, SAMPLE / max(rows.count(), 1))
    sampled = rows.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < F.lit(
        int(share * (1 << 30)))).select("key", "n_tokens").toArrow().sort_by("key")
    passed = np.cumsum(sampled["n_tokens"].to_numpy())
    cuts = [passed[-1] * i // ranges for i in range(1, ranges)] if passed.size else []
    bounds = sampled["key"].to_numpy()[np.searchsorted(passed, np.array(cuts, np.int64))]

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy()).astype(np.int32))

    ranged = rows.withColumn("part", range_of("key"))
    sums = ranged.groupBy("part").agg(F.sum("n_tokens")).collect()
    tokens = np.zeros(ranges + 1, np.int64)
    for part, n in sums:
        tokens[part + 1] = n
    starts = np.cumsum(tokens)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = -1, 0
        for batch in batches:
            out = []
            for at, doc_id, packed in zip(batch["part"].to_pylist(), batch["doc_id"].to_pylist(),
                                          batch["ids"]):
                if at != part:
                    part, place = at, int(starts[at])
                ids = np.frombuffer(packed.as_py(), kind).astype("<u4")
                start = 0
                while start < ids.size:
                    offset = place % length
                    n = min(length - offset, ids.size - start)
                    out.append((doc_id, start, n, zlib.crc32(ids[start:start + n].tobytes()),
                                ids.size, place // length, offset))
                    start += n
                    place += n
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                [f.split()[0] for f in PIECES.split(", ")])

    return (ranged.select("part", "key", "row", "doc_id", "ids")
            .repartitionById(ranges, F.col("part")).sortWithinPartitions("key", "row")
            .mapInArrow(cut, PIECES))
