"""Byte-level BPE in two tiers: a minimal perfect hash of the vocabulary, and a heap over linked
bytes for everything that is not in it."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from thermolens.llm.batches import by_bytes, ranges
from thermolens.llm.common import whole_text
from thermolens.llm.shingles import hash_runs, mix

#: Bytes of text, and pre-tokens of a single text, that are looked up at a time.
CHUNK, MATCHES = 1 << 20, 1 << 17
#: Pre-tokens outside the vocabulary whose ids a task remembers, and the longest of them in bytes.
MEMORY, LONGEST = 1 << 18, 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file, in order of rank; ranks count from 0 without gaps."""
    with open(path, "rb") as file:
        ranks = {int(rank): base64.b64decode(token)
                 for token, rank in map(bytes.split, file) if token}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """A minimal perfect hash of n different byte strings: n places, each with one string.

    Strings are dealt to buckets by one hash. Every bucket, large ones first, looks for the
    displacement of a second hash that puts its strings in free places; buckets of one string then
    take the places that are left, told outright (a negative displacement). A string that is not
    among the n also falls on a place, so what lies there is compared byte by byte.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.raw = np.frombuffer(b"".join(keys), np.uint8)
        self.sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.longest = int(self.sizes.max(initial=0))
        self.buckets = max(1, len(keys) // 4)
        first, second = self._hashes(self.raw, self.starts, self.starts + self.sizes)
        bucket = (first % np.uint64(self.buckets)).astype(np.int64)
        members = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        begins = np.cumsum(counts) - counts
        self.displacement = np.zeros(self.buckets, np.int64)
        self.key_at = np.full(len(keys), -1, np.int64)
        tries = np.arange(64, dtype=np.uint64)
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] < 2:
                break
            found = members[begins[b]:begins[b] + counts[b]]
            shift = 0
            while True:
                places = self._place(second[found], tries[:, None] + np.uint64(shift))
                fits = (self.key_at[places] < 0).all(1)
                fits &= (np.diff(np.sort(places, 1), axis=1) > 0).all(1)
                if fits.any():
                    best = int(fits.argmax())
                    break
                shift += tries.size
            self.displacement[b] = shift + best
            self.key_at[places[best]] = found
        alone = np.flatnonzero(counts == 1)
        free = np.flatnonzero(self.key_at < 0)
        self.displacement[alone] = -1 - free
        self.key_at[free] = members[begins[alone]]

    @staticmethod
    def _hashes(raw, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        return hash_runs(raw, starts, ends), hash_runs(raw, starts, ends, kind=1)

    def _place(self, second: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        return (mix(second + displacement * _STEP) % np.uint64(self.sizes.size)).astype(np.int64)

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each run of bytes among the keys, or -1."""
        if not self.sizes.size or not starts.size:
            return np.full(starts.size, -1, np.int64)
        first, second = self._hashes(raw, starts, ends)
        shift = self.displacement[(first % np.uint64(self.buckets)).astype(np.int64)]
        place = np.where(shift < 0, -1 - shift,
                         self._place(second, np.maximum(shift, 0).astype(np.uint64)))
        key = self.key_at[place]
        sizes = ends - starts
        maybe = np.flatnonzero((self.sizes[key] == sizes) & (sizes > 0))
        wide = sizes[maybe]
        same = raw[ranges(starts[maybe], wide)] == self.raw[ranges(self.starts[key[maybe]], wide)]
        equal = np.logical_and.reduceat(same, np.cumsum(wide) - wide) if maybe.size else same
        out = np.full(starts.size, -1, np.int64)
        out[maybe[equal]] = key[maybe[equal]]
        return out


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: bytes are linked to their neighbours, and the pair whose merged
    bytes rank lowest, the leftmost of equals, is merged until none is left. A heap holds the pairs;
    one whose parts were merged otherwise is passed over when it comes up."""
    n, rank_of = len(word), ranks.get
    after = list(range(1, n + 1))  # where the part that begins here ends; 0 for inner bytes
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1)
            if (rank := rank_of(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = after[i]
        if not middle or middle >= n or after[middle] != end:
            continue
        after[i], after[middle] = end, 0
        if end < n:
            before[end] = i
            if (rank := rank_of(word[i:after[end]])) is not None:
                heapq.heappush(heap, (rank, i, after[end]))
        if i:
            left = before[i]
            if (rank := rank_of(word[left:end])) is not None:
                heapq.heappush(heap, (rank, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:after[i]]])
        i = after[i]
    return out


class ByteBpe:
    """A vocabulary in order of rank and the pattern that splits texts in front of the merges. What
    a worker remembers of merged pre-tokens is bounded, and serves all its tasks."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens, self.pattern = tokens, pattern
        self.table = PerfectHash(tokens)
        self.wake()

    def wake(self) -> None:
        self.ranks = {token: i for i, token in enumerate(self.tokens)}
        self.split = regex.compile(self.pattern)
        self.known: dict[bytes, list[int]] = {}

    def __getstate__(self) -> dict:
        return {"tokens": self.tokens, "pattern": self.pattern, "table": self.table}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.wake()

    def _missing(self, word: bytes) -> list[int]:
        found = self.known.get(word)
        if found is None:
            found = merge_bytes(word, self.ranks)
            if len(word) <= LONGEST:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[word] = found
        return found

    def ids_of(self, encoded: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens that lie end to end, and how many ids each has."""
        raw = np.frombuffer(encoded, np.uint8)
        starts = np.concatenate(([0], ends)).astype(np.int64)[:-1]
        found = self.table.find(raw, starts, ends)
        sizes = np.ones(ends.size, np.int64)
        missed = np.flatnonzero(found < 0)
        merged, counts = [], []
        for i, j in zip(starts[missed].tolist(), ends[missed].tolist()):
            ids = self._missing(encoded[i:j])
            merged += ids
            counts.append(len(ids))
        sizes[missed] = counts
        out = np.empty(int(sizes.sum()), np.int32)
        place = np.cumsum(sizes) - sizes
        hit = found >= 0
        out[place[hit]] = found[hit]
        out[ranges(place[missed], sizes[missed])] = merged
        return out, sizes

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text. Pre-tokens of many short texts are looked up together, those of
        a long one in several turns."""
        out: list[np.ndarray | None] = [None] * len(texts)
        waiting: list[tuple[int, int]] = []
        words: list[str] = []

        def look_up() -> np.ndarray:
            joined = "".join(words)
            encoded = joined.encode()
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
            if len(encoded) != len(joined):
                raw = np.frombuffer(encoded, np.uint8)
                letters = np.append(np.flatnonzero((raw & 0xC0) != 0x80), raw.size)
                ends = letters[ends]
            ids, sizes = self.ids_of(encoded, ends)
            return ids, np.concatenate(([0], np.cumsum(sizes)))

        def flush() -> None:
            ids, passed = look_up()
            at = 0
            for i, n in waiting:
                out[i] = ids[passed[at]:passed[at + n]]
                at += n
            waiting.clear()
            words.clear()

        for i, text in enumerate(texts):
            if len(text) > MATCHES:  # so that the pre-tokens of a long text are never all at hand
                flush()
                found, parts = (m[0] for m in self.split.finditer(text)), []
                while words := list(islice(found, MATCHES)):
                    parts.append(look_up()[0])
                out[i] = np.concatenate(parts)
                words = []
                continue
            own = self.split.findall(text)
            waiting.append((i, len(own)))
            words += own
            if len(words) >= MATCHES:
                flush()
        flush()
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids; an id outside the vocabulary gives nothing."""
        ids = ids[(ids >= 0) & (ids < len(self.tokens))]
        sizes = self.table.sizes[ids]
        return self.table.raw[ranges(self.table.starts[ids], sizes)].tobytes()


def lists(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([x.size for x in found]))).astype(np.int32)
    flat = np.concatenate(found) if found else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, by the ranks of the file at ``path``.

    ``pattern`` splits a text into pre-tokens; special tokens are not looked for. A pre-token that
    is in the vocabulary is found by a minimal perfect hash, for a chunk of texts at a time; any
    other is merged from its bytes (``merge_bytes``). The table is broadcast: its size is the
    vocabulary's. Nothing is shuffled, and chunks are bounded in bytes, so a task needs little more
    memory than its longest text.

    A null or empty text has no ids (an empty array); repeated rows give repeated results; a null
    doc_id stays null; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ByteBpe(read_ranks(path), pattern))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in batches:
            for part in by_bytes(batch, "text", CHUNK):
                ids = bpe.encode_all(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["doc_id"], lists(ids)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       whole_text().alias("text")).mapInArrow(look_up, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and ``decoded``, the bytes that the ids stand for (binary, as ids may cut a
    character). No ids give no bytes, null ids null, an id outside the vocabulary nothing."""
    shared = encoded.sparkSession.sparkContext.broadcast(ByteBpe(read_ranks(path), r"[\s\S]"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                texts = [None if ids.values is None else bpe.decode(
                    ids.values.to_numpy(zero_copy_only=False)) for ids in part["ids"]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["ids"], pa.array(texts, pa.binary())],
                    ["doc_id", "ids", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        look_up, "doc_id long, ids array<int>, decoded binary")
