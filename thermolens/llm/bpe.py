"""BPE encoding and decoding: each distinct word is encoded once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from thermolens.llm.common import partitions, steady, whole_text, with_row
from thermolens.llm.shingles import hash_runs, words_of
from thermolens.llm.tokens import encoder

#: Longest word, in bytes, of the broadcast table.
HOT_BYTES = 64
#: Words and parts of words that a task remembers besides.
MEMORY = 1 << 16


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
            ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update(text.as_py().encode().split())
            if len(counts) > 400_000:
                yield rows(counts)
                counts = Counter()
    yield rows(counts)


def _encode_words(path: str):
    """Adds ``ids`` to sorted words; equal words stand together, and are encoded once."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, last, ids = encoder(path, MEMORY), None, b""
        for batch in batches:
            out = []
            for word in batch["word"].to_pylist():
                if word != last:
                    last, ids = word, bpe.ids(bpe.word(word)).astype("<u4").tobytes()
                out.append(ids)
            rest = [c for c in batch.schema.names if c != "word"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in rest), pa.array(out, pa.binary())], [*rest, "ids"])
        bpe.forget()

    return encode


class HotWords:
    """A bounded table of frequent words, by two hashes, with their ids in order of rank."""

    def __init__(self, words: list[bytes], ids: list[bytes]) -> None:
        raw = np.frombuffer(b" ".join(words), np.uint8)
        runs = words_of(raw)
        first, second = hash_runs(raw, *runs), hash_runs(raw, *runs, kind=1)
        order = np.argsort(first)
        self.first, self.second = first[order], second[order]
        self.rank = order.astype(np.int32) + 1
        self.sizes = np.array([0, *(len(x) // 4 for x in ids)], np.int32)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = np.frombuffer(b"".join(ids), "<u4")

    def codes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The rank of each word, counted from 1, or 0."""
        if not self.first.size:
            return np.zeros(starts.size, np.int64)
        first = hash_runs(raw, starts, ends)
        at = np.minimum(np.searchsorted(self.first, first), self.first.size - 1)
        same = (self.first[at] == first) & (
            self.second[at] == hash_runs(raw, starts, ends, kind=1))
        return np.where(same, self.rank[at], 0).astype(np.int64)

    def fill(self, codes: np.ndarray, found: list[bytes]) -> bytes:
        """The ids of a text; words without rank take theirs from ``found``, in order."""
        gaps = np.flatnonzero(codes == 0)
        sizes = self.sizes[codes].astype(np.int64)
        sizes[gaps] = [len(x) // 4 for x in found]
        place = np.cumsum(sizes) - sizes
        starts = self.starts[codes] - place
        starts[gaps] = -place[gaps]  # read somewhere, written over below
        out = self.ids[np.maximum(0, np.minimum(
            np.repeat(starts, sizes) + np.arange(sizes.sum()), self.ids.size - 1))] \
            if self.ids.size else np.zeros(int(sizes.sum()), "<u4")
        for gap, ids in zip(gaps.tolist(), found):
            out[place[gap]:place[gap] + sizes[gap]] = np.frombuffer(ids, "<u4")
        return out.tobytes()


def hot_words(docs: DataFrame, path: str, limit: int, sample: int) -> HotWords:
    """The most frequent words of about ``sample`` documents, at most ``limit`` of them, and none
    over HOT_BYTES bytes. Which they are decides how texts travel, not the result."""
    share = min(1.0, sample / max(docs.count(), 1))
    text = whole_text()
    counted = (docs.select(text.alias("text"))
               .filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
               .mapInArrow(_count_words, "word binary, n long")
               .filter(F.octet_length("word") <= HOT_BYTES)
               .groupBy("word").agg(F.sum("n").alias("n")).persist())
    words = counted.withColumn("level", F.floor(F.log2("n") * 16).cast("int"))
    lowest, total = None, 0
    for row in sorted(words.groupBy("level").count().collect(), reverse=True):
        total += row["count"]
        if total > limit:
            break
        lowest = row["level"]
    if lowest is None:
        return HotWords([], [])
    found = (words.filter(F.col("level") >= lowest).select("word", F.col("word").alias("w"), "n")
             .mapInArrow(_encode_words(path), "w binary, n long, ids binary").toArrow())
    counted.unpersist()
    found = found.sort_by([("n", "descending"), ("w", "ascending")])
    return HotWords(found["w"].to_pylist(), found["ids"].to_pylist())


def _varint(codes: np.ndarray) -> bytes:
    """Seven bits a byte, the low ones first, the top bit set on all but a number's last byte."""
    size = 1 + (codes >= 1 << 7) + (codes >= 1 << 14) + (codes >= 1 << 21)
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for i in range(4):
        has = size > i
        out[at[has] + i] = (codes[has] >> 7 * i & 127) | np.where(size[has] > i + 1, 128, 0)
    return out.tobytes()


def _from_varint(packed: bytes) -> np.ndarray:
    if not packed:
        return np.empty(0, np.int64)
    raw = np.frombuffer(packed, np.uint8).astype(np.int64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))
    shift = np.arange(raw.size) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127) << 7 * shift, starts)


def encode(docs: DataFrame, path: str, limit: int = 1 << 20, sample: int = 50_000) -> DataFrame:
    """Ids of every whole text: doc_id and ids (packed little-endian unsigned 32-bit integers).

    Words are split in Spark, each distinct word is encoded once, and ids are joined back by
    position. The table of distinct words has two parts. Its frequent part (``hot_words``, taken
    from a bounded sample) is broadcast, and a text travels as one number per word, the word's
    rank there. Every other word is shuffled to where all its occurrences meet, encoded there
    once, and sent to its text and position, where ids fill the gaps in order.

    Null and empty texts have no ids; repeated rows give repeated results; other columns are not
    read, and an empty table gives no rows. Rows that do not come straight from files are written
    first, as they are read three times.
    """
    docs = steady(docs)
    parts = partitions(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(hot_words(docs, path, limit, sample))
    numbered = with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                    whole_text().alias("text")), "doc_id", "text")

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for text in batch["text"]:
                raw = np.frombuffer(text.as_py().encode(), np.uint8)
                packed.append(_varint(table.value.codes(raw, *words_of(raw))))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array([-1] * len(packed), pa.int32()), batch["doc_id"],
                 pa.array(packed, pa.binary())], ["row", "pos", "doc_id", "ids"])

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, missing = [], [], []
            for row, text in zip(batch["row"].to_pylist(), batch["text"]):
                encoded = text.as_py().encode()
                raw = np.frombuffer(encoded, np.uint8)
                starts, ends = words_of(raw)
                at = np.flatnonzero(table.value.codes(raw, starts, ends) == 0)
                rows.append(np.full(at.size, row))
                places.append(at)
                missing += [encoded[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())]
            if missing:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(rows)),
                     pa.array(np.concatenate(places).astype(np.int32)),
                     pa.array(missing, pa.binary())], ["row", "pos", "word"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, codes, found = None, None, []

        def out(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in made], pa.int64()),
                 pa.array([x[1] for x in made], pa.binary())], ["doc_id", "ids"])

        for batch in batches:
            made = []
            for pos, doc_id, ids in zip(batch["pos"].to_pylist(), batch["doc_id"].to_pylist(),
                                        batch["ids"]):
                if pos >= 0:
                    found.append(ids.as_py())
                    continue
                if codes is not None:
                    made.append((doc, table.value.fill(codes, found)))
                doc, codes, found = doc_id, _from_varint(ids.as_py()), []
            yield out(made)
        if codes is not None:
            yield out([(doc, table.value.fill(codes, found))])

    texts = numbered.mapInArrow(sequences, "row long, pos int, doc_id long, ids binary")
    filled = (numbered.select("row", "text").mapInArrow(gaps, "row long, pos int, word binary")
              .repartition(parts, "word").sortWithinPartitions("word")
              .mapInArrow(_encode_words(path), "row long, pos int, ids binary")
              .select("row", "pos", F.lit(None).cast("long").alias("doc_id"), "ids"))
    return (texts.unionByName(filled).repartition(parts, "row")
            .sortWithinPartitions("row", "pos").mapInArrow(fill, "doc_id long, ids binary"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the decoded text: each id is looked up in the table of pieces, which
    is broadcast (its size is the vocabulary's), and pieces are joined by a space.

    An id without a piece gives nothing, no ids give an empty text, null ids a null text.
    """
    tokenizer = Tokenizer.from_file(path)
    size = max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1
    table = encoded.sparkSession.sparkContext.broadcast(
        [tokenizer.id_to_token(i) for i in range(size)])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = table.value
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                texts = []
                for ids in part["ids"]:
                    packed = ids.as_py()
                    texts.append(None if packed is None else " ".join(
                        [p for i in np.frombuffer(packed, "<u4").tolist()
                         if i < size and (p := piece[i]) is not None]))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["ids"], pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(
        look_up, "doc_id long, ids binary, decoded string")
