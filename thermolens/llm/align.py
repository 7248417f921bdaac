"""Alignment of two tokenizers over the bytes of a text, by lockstep merging."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from thermolens.llm.batches import by_bytes, ranges
from thermolens.llm.common import settle, whole_text, with_row
from thermolens.llm.tokens import ALPHABET

#: Bytes of text that are aligned at a time.
CHUNK = 1 << 20
#: Bytes of a text that one entry of the state vector walks; a longer text has several entries.
LANE = 1024
#: Pieces of text whose ids a worker remembers, the characters of the longest of them, and how many
#: new ones the tokenizers get as one text.
REMEMBER, LONGEST, TOGETHER = 1 << 18, 64, 128
#: An empty word or white space at the end: a space behind it may belong to a token with it.
OPEN = r"(^|[\x{9}-\x{d}\x{1c}-\x{1f}\x{85}\x{180e}\pZ])\z"
#: Id pairs that a task counts before it hands them on.
COUNTED = 1 << 20


class Tokenizers:
    """Tokenizer A (a byte-level file of the tokenizers library) and B (a sentencepiece model), and
    the bytes of all their tokens. Each Python worker loads them once.

    Both are asked for different pieces of text only, as no token of either reaches across a space
    from a character that is not white space: A's pattern ends a match there, and no piece of B
    holds one. Files of which that is not known get whole texts.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {chr(c): b for b, c in ALPHABET.items()}
        size = max(self.a.get_vocab(with_added_tokens=True).values()) + 1
        self.bytes_a = []
        for i in range(size):
            token = self.a.id_to_token(i) or ""
            self.bytes_a.append(bytes(byte_of[c] for c in token) if set(token) <= set(byte_of)
                                else token.encode())
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # every id with what may follow it in the text of a document's groups
        self.names = pa.array(
            f"{i}{mark}" for i in range(max(size, len(self.bytes_b))) for mark in (*",|;", ""))
        told = json.loads(self.a.to_str())
        split = told["pre_tokenizer"] or {}
        self.cuts = (
            told["normalizer"] is None and split.get("type") == "ByteLevel" and split["use_regex"]
            and all(x["special"] for x in told["added_tokens"])
            and not any(b" " in x.lstrip(b" ") for x in self.bytes_b))
        self._forget()

    def _forget(self) -> None:
        # pieces by number, and the ids of A and of B with where each piece's start and the end
        self.number: dict[str, int] = {}
        self.known = [_laid([]), _laid([])]

    def _ids(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of every text by both; none where their bytes are not a space and the text."""
        all_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        for text, a, b in zip(texts, all_a, self.b.encode(texts, num_threads=1)):
            whole, a = b" " + text.encode(), a.ids
            same = all(b"".join([of[k] for k in ids]) == whole
                       for ids, of in ((a, self.bytes_a), (b, self.bytes_b)))
            yield (a, b) if same else ([], [])

    def _learn(self, pieces: list[str]) -> None:
        """Number different pieces that are not open. They are joined to texts of several pieces,
        whose tokens are dealt out by where pieces end; where bytes differ, each is a text."""
        groups = [pieces[i:i + TOGETHER] for i in range(0, len(pieces), TOGETHER)]
        joined = list(self._ids([" ".join(x) for x in groups]))
        whole = [p for x, ids in zip(groups, joined) if ids[0] for p in x]
        single = [p for x, ids in zip(groups, joined) if not ids[0] for p in x]
        alone = list(self._ids(single))
        ends = np.cumsum(pc.binary_length(pa.array(whole, pa.string())).to_numpy() + 1)
        for k, sizes in enumerate((self.size_a, self.size_b)):
            ids, _ = _laid([x[k] for x in joined])
            cut = np.searchsorted(np.cumsum(sizes[ids]), ends) + 1
            self.known[k] = _behind(self.known[k], (ids, np.concatenate(([0], cut))),
                                    _laid([x[k] for x in alone]))
        self.number.update(zip(whole + single, range(len(self.number), 1 << 62)))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        if len(self.number) >= REMEMBER:
            self._forget()
        self._learn([p for p in pieces if p not in self.number])
        return np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has: by A, then by B.
        None where their bytes are not a space and the text."""
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        told, base = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        names, codes = told.dictionary, told.indices.to_numpy()
        words = names.to_numpy(zero_copy_only=False).tolist()
        is_open = pc.match_substring_regex(names, OPEN).to_numpy(zero_copy_only=False)
        if not self.cuts:
            is_open = np.ones(is_open.size, bool)
        # a word behind an open one belongs to its piece, and so does an empty word at a text's end
        begins = np.concatenate(([True], ~is_open[codes]))
        begins[base[1:] - 1] &= np.array([not t.endswith(" ") for t in texts], bool)
        begins[base] = True
        edges = np.flatnonzero(begins)
        code = codes[edges[:-1]]
        usual = ~is_open & (pc.utf8_length(names).to_numpy() <= LONGEST)
        usual = usual[code] & (np.diff(edges) == 1)
        used, at = np.unique(code[usual], return_inverse=True)
        number = np.empty(code.size, np.int64)
        number[usual] = self._numbers([words[k] for k in used.tolist()])[at]
        # pieces of several words, and long and open ones, are texts of their own
        other = np.flatnonzero(~usual)
        others = [" ".join([words[k] for k in codes[i:j].tolist()])
                  for i, j in zip(edges[other].tolist(), edges[other + 1].tolist())]
        place = {p: len(self.number) + k for k, p in enumerate(dict.fromkeys(others))}
        number[other] = [place[p] for p in others]
        own = list(self._ids(list(place)))
        # a text with a piece that has no ids has none at all
        counts = np.diff(np.searchsorted(edges, base))
        text_of = np.repeat(np.arange(len(texts)), counts)
        tables = [_behind(self.known[k], _laid([x[k] for x in own])) for k in (0, 1)]
        lost = np.unique(text_of[np.diff(tables[0][1])[number] == 0])
        out = []
        for ids, starts in tables:
            sizes = np.diff(starts)[number]
            sizes[np.isin(text_of, lost)] = 0
            out += [ids[ranges(starts[number], sizes)].astype(np.int64),
                    np.bincount(text_of, sizes, len(texts)).astype(np.int64)]
        return tuple(out)


def _laid(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists end to end, and where each starts, with the end."""
    starts = np.cumsum([0, *map(len, parts)])
    return np.fromiter(chain.from_iterable(parts), np.int32, starts[-1]), starts


def _behind(*tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Several of what ``_laid`` returns, as one."""
    first = np.cumsum([0, *(ids.size for ids, _ in tables)])
    return (np.concatenate([ids for ids, _ in tables]), np.concatenate(
        [[0], *(n + starts[1:] for n, (_, starts) in zip(first, tables))]).astype(np.int64))


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Tokenizers(path_a, path_b)
    return _LOADED[path_a, path_b]


def lanes(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where texts that lie end to end are begun and left by the entries of the state vector: each
    text at its start, and a long one also after every ``width`` bytes."""
    counts = -(-lengths // width)
    begin = np.repeat(np.cumsum(lengths) - lengths, counts)
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = begin + turn * width
    return begin, np.minimum(begin + width, np.repeat(np.cumsum(lengths), counts))


def merge(ends_a: np.ndarray, ends_b: np.ndarray, begin: np.ndarray, stop: np.ndarray):
    """Links and cuts of two sequences of tokens over the same bytes, given by where tokens end.

    Every lane has a pointer into A and one into B, at the tokens that cover its first byte. In a
    step all lanes at once emit the pair they point at, as a cut if both tokens end together, and
    advance the token that ends first, or both. A lane that has reached its stop leaves the vectors.
    A pair belongs to the lane of the first byte that its tokens share.

    Returns the places in A and in B of all links, in no order, and of all cuts, in order.
    """
    at_a = np.searchsorted(ends_a, begin, "right")
    at_b = np.searchsorted(ends_b, begin, "right")
    first_a = np.concatenate(([0], ends_a))  # where each token starts
    first_b = np.concatenate(([0], ends_b))
    owned = np.maximum(first_a[at_a], first_b[at_b]) >= begin
    links, cuts = [], []
    while at_a.size:
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        together = end_a == end_b
        if owned is None:
            links.append((at_a, at_b))
            cuts.append((at_a[together], at_b[together]))
        else:  # a lane may begin inside a pair that an earlier lane emits
            links.append((at_a[owned], at_b[owned]))
            cuts.append((at_a[owned & together], at_b[owned & together]))
            owned = None
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        going = np.minimum(end_a, end_b) < stop
        if not going.all():
            at_a, at_b, stop = at_a[going], at_b[going], stop[going]
    joined = [np.concatenate(x) if x else np.empty(0, np.int64)
              for x in (*zip(*links),) + (*zip(*cuts),)] if links else [np.empty(0, np.int64)] * 4
    return joined[0], joined[1], np.sort(joined[2]), np.sort(joined[3])


@dataclass
class Aligned:
    """What texts of one chunk hold, one entry per text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pairs: list[np.ndarray]  # distinct id pairs, as a * size of B + b
    times: list[np.ndarray]  # how many links each of them has


def align_texts(both: Tokenizers, texts: list[str], width: int = LANE) -> Aligned:
    a, n_a, b, n_b = both.encode(texts)
    ends_a, ends_b = np.cumsum(both.size_a[a]), np.cumsum(both.size_b[b])
    base_a = np.concatenate(([0], np.cumsum(n_a)))
    base_b = np.concatenate(([0], np.cumsum(n_b)))
    lengths = np.diff(np.concatenate(([0], ends_a))[base_a])
    link_a, link_b, cut_a, cut_b = merge(ends_a, ends_b, *lanes(lengths, width))
    text_of = np.repeat(np.arange(len(texts)), n_a)
    # groups: the ids of A and of B take turns, each followed by its mark
    order = np.empty(a.size + b.size, np.int64)
    sizes_a, sizes_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    marks_a, marks_b = np.zeros(a.size, np.int64), np.zeros(b.size, np.int64)
    marks_a[cut_a], marks_b[cut_b] = 1, 2
    order[np.arange(a.size) + np.repeat(cut_b + 1 - sizes_b, sizes_a)] = 4 * a + marks_a
    order[np.arange(b.size) + np.repeat(cut_a + 1, sizes_b)] = 4 * b + marks_b
    base = base_a + base_b
    order[base[1:][np.diff(base) > 0] - 1] += 1  # no mark behind the last one
    groups = pc.binary_join(pa.ListArray.from_arrays(
        pa.array(base.astype(np.int32)), both.names.take(pa.array(order))), "").to_pylist()
    # links of equal id pairs in one text are counted
    space = len(both.bytes_a) * len(both.bytes_b)
    key, times = np.unique(text_of[link_a] * space + a[link_a] * len(both.bytes_b) + b[link_b],
                           return_counts=True)
    split = np.searchsorted(key, np.arange(1, len(texts)) * space)
    return Aligned(
        n_a, n_b, np.bincount(text_of[cut_a], minlength=len(texts)),
        np.bincount(text_of[link_a], minlength=len(texts)), groups,
        np.split(key % space, split), np.split(times, split))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([x.size for x in parts]))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups (text), pairs and times of every document.

    ``pairs`` are a document's different linked id pairs, as a's id times the number of B's ids plus
    b's id, and ``times`` says how many of its links each has. Nothing is shuffled.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        for batch in batches:
            for part in by_bytes(batch, "text", CHUNK):
                found = align_texts(both, part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["doc_id"], *map(pa.array, (
                        found.n_a, found.n_b, found.n_groups, found.n_links, found.groups)),
                     _lists(found.pairs, pa.int64()), _lists(found.times, pa.int32())],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs",
                     "times"])

    return with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                whole_text().alias("text")), "doc_id", "text").mapInArrow(
        read, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
              "groups string, pairs array<long>, times array<int>")


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of id pairs, added up as far as a bounded buffer allows."""
    pairs, times = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add_up() -> None:
        nonlocal pairs, times
        both = [(pairs, times), *waiting]
        pairs, at = np.unique(np.concatenate([p for p, _ in both]), return_inverse=True)
        sums = np.zeros(pairs.size, np.int64)
        np.add.at(sums, at, np.concatenate([t for _, t in both]))
        times = sums
        waiting.clear()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])

    size = 0
    for batch in batches:
        waiting.append((batch["pairs"].flatten().to_numpy(),
                        batch["times"].flatten().to_numpy().astype(np.int64)))
        size += waiting[-1][0].size
        if size >= COUNTED:
            add_up()
            size = 0
            if pairs.size >= COUNTED:
                yield out()
                pairs, times = pairs[:0], times[:0]
    add_up()
    yield out()


def frequent(table: DataFrame, limit: int) -> pa.Table:
    """The rows of the most frequent pairs, at most ``limit``, in order of pair. Pairs are told by
    a sixteenth of a power of two of their count, all of one step or none."""
    step = F.floor(F.log2("n") * 16).cast("int")
    lowest, total = None, 0
    for row in sorted(table.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > limit:
            break
        lowest = row["step"]
    rows = table.filter(step >= F.lit(lowest)) if lowest is not None else table.limit(0)
    return rows.toArrow().sort_by("pair")


def pair_counts(told: DataFrame, size_b: int) -> DataFrame:
    """pair, n (links that hold it in all documents) and best (whether no pair with the same id of
    B has more)."""
    counts = settle(told.select("pairs", "times").mapInArrow(_count_pairs, "pair long, n long")
                    .groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    # One row per id of B: its size is the vocabulary's.
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return settle(counts.withColumn("b", F.col("pair") % size_b).join(F.broadcast(most), "b")
                  .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def summary(docs: DataFrame, path_a: str, path_b: str, limit: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best, count_sum,
    groups_sha256.

    A is read from a space and the text, B from the text, which it puts a space in front of. Two
    tokens are linked where their bytes overlap; where both end, a group ends. A pair of ids counts
    the links of all documents that hold it: ``count_sum`` adds these counts up over a document's
    links, and ``n_best`` says for how many links no other pair with the same id of B counts more.

    Documents are aligned where they lie, and what is written of one is its numbers and different
    pairs. Pairs are added up in every task before they are shuffled. The ``limit`` most frequent
    ones are then broadcast; a document's other pairs are joined with the counts, and as they are
    the rare ones, no key of that join is hot. ``limit`` decides how counts travel, not the result.

    A null or empty text, and one whose bytes a tokenizer changes, has no tokens: zeros and an empty
    ``groups_sha256``. Repeated rows count each; a null doc_id stays null; an empty table gives no
    rows; other columns are not read.
    """
    size_b = len(tokenizers(path_a, path_b).bytes_b)
    told = settle(aligned(docs, path_a, path_b).withColumn(
        "groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit("")))
        .drop("groups"), "aligned")
    table = pair_counts(told, size_b)
    top = frequent(table, limit)
    shared = docs.sparkSession.sparkContext.broadcast(
        (top["pair"].to_numpy(), top["n"].to_numpy(), top["best"].to_numpy()))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs = batch["pairs"].flatten().to_numpy()
            times = batch["times"].flatten().to_numpy().astype(np.int64)
            offsets = batch["pairs"].offsets.to_numpy() - batch["pairs"].offsets[0].as_py()
            at = np.minimum(np.searchsorted(known, pairs), max(known.size - 1, 0))
            found = known[at] == pairs if known.size else np.zeros(pairs.size, bool)

            def added(values: np.ndarray) -> pa.Array:
                passed = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
                return pa.array(passed[offsets[1:]] - passed[offsets[:-1]])

            sums = [np.zeros(pairs.size, np.int64) for _ in range(2)]
            sums[0][found] = times[found] * n[at[found]]
            sums[1][found] = times[found] * best[at[found]]
            left = np.concatenate(([0], np.cumsum(~found)))[offsets].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in _NUMBERS), added(sums[0]), added(sums[1]),
                 pa.ListArray.from_arrays(pa.array(left), pa.array(pairs[~found])),
                 pa.ListArray.from_arrays(pa.array(left), pa.array(times[~found]))],
                [*_NUMBERS, "known_sum", "known_best", "pairs", "times"])

    known = settle(told.mapInArrow(
        look_up, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                 "groups_sha256 string, known_sum long, known_best long, pairs array<long>, "
                 "times array<long>"), "known")
    rare = (known.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("z"))
            .select("row", F.col("z.pairs").alias("pair"), F.col("z.times").alias("times"))
            .join(table, "pair").groupBy("row").agg(
                F.sum(F.col("times") * F.col("n")).alias("rare_sum"),
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best")))
    return known.drop("pairs", "times").join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("known_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("known_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256")


_NUMBERS = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
