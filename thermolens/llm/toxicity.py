"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermolens.llm.common import whole_text

WORD = re.compile(r"[^\W\d_]+")
SPACE = 1 << 20
MEMORY = 1 << 17
FACTORS = 8
#: The value of a term whose share hardly differs between the labels; that of all others is 1.
HELD_BACK = 0.3


def terms_of(text: str, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Sorted distinct hashed terms: lower-case words and, of words over four letters, their
    beginnings of four and five letters, which inflected or disguised forms share."""
    found: set[int] = set()
    for word in set(WORD.findall(text.lower())):
        terms = known.get(word)
        if terms is None:
            if len(known) >= MEMORY:
                known.clear()
            named = {word, *(f"{word[:n]}-" for n in (4, 5) if len(word) > 4)}
            terms = known[word] = tuple(zlib.crc32(t.encode()) % SPACE for t in named)
        found.update(terms)
    return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class Machine:
    """Weights of the terms seen often enough; all others weigh nothing."""

    terms: np.ndarray  # sorted
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    values: np.ndarray | None = None  # of the terms; 1 if not given

    def scores(self, documents: list[np.ndarray]) -> np.ndarray:
        """The probability of the label for each document's terms, all documents at once."""
        n = len(documents)
        if not self.terms.size or not n:
            return np.full(n, 1 / (1 + np.exp(-self.bias)))
        flat = np.concatenate(documents)
        owner = np.repeat(np.arange(n), [d.size for d in documents])
        at = np.searchsorted(self.terms, flat)
        at[at == self.terms.size] = 0
        known = self.terms[at] == flat
        at, owner = at[known], owner[known]
        value = np.ones(at.size) if self.values is None else self.values[at]
        x = value * length(np.bincount(owner, value ** 2, n))[owner]
        y = self.bias + np.bincount(owner, self.linear[at] * x, n)
        for factor in self.factors.T:
            v = factor[at] * x
            y += (np.bincount(owner, v, n) ** 2 - np.bincount(owner, v ** 2, n)) / 2
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def length(squares: np.ndarray) -> np.ndarray:
    """What the values of a document's terms are multiplied by, so that long ones weigh no more."""
    return np.maximum(squares, 1) ** -0.25


def counted(documents: list[np.ndarray]) -> np.ndarray:
    """How many documents hold each of SPACE terms; a part of the documents at a time."""
    out = np.zeros(SPACE, np.int64)
    for k in range(0, len(documents), 512):
        out += np.bincount(np.concatenate(documents[k:k + 512]), minlength=SPACE)
    return out


def fit(documents: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, epochs: int = 6,
        rate: float = 0.1, penalty: float = 1e-4, least: int = 3, contrast: float = 4.0,
        seed: int = 5) -> Machine:
    """Logistic loss, minibatches, AdaGrad.

    Terms in fewer than ``least`` documents are left out. Those whose share of documents differs
    between the labels by less than ``contrast`` standard errors could help to learn single
    documents by heart, but may matter in pairs: they stay, with the value HELD_BACK and small
    steps, and enter after ``epochs`` rounds with the others alone, so they learn what is left to
    explain, in as many rounds again.
    """
    seen, toxic = (counted([d for d, y in zip(documents, labels) if y or not only])
                   for only in (False, True))
    terms = np.flatnonzero(seen).astype(np.int32)
    seen, toxic = seen[terms], toxic[terms]
    sides = np.maximum([labels.sum(), labels.size - labels.sum()], 1)
    overall = seen / max(labels.size, 1)
    error = np.sqrt(overall * (1 - overall) * (1 / sides).sum()) + 1e-9
    apart = np.abs(toxic / sides[0] - (seen - toxic) / sides[1]) / error
    often = seen >= least
    terms, plain = terms[often], apart[often] >= contrast
    values = np.where(plain, 1.0, HELD_BACK)
    random = np.random.default_rng(seed)
    share = (labels.sum() + 0.5) / (labels.size + 1)
    bias = float(np.log(share / (1 - share)))
    table = np.zeros((terms.size, 1 + factors))
    table[:, 1:] = random.normal(0, 0.02, (terms.size, factors))
    grown = np.where(plain, 1e-3, 1.0)[:, None].repeat(1 + factors, 1)
    grown_bias = 1.0
    inside = []
    for d in documents:
        at = np.searchsorted(terms, d)
        at[at == terms.size] = 0
        inside.append(at[terms[at] == d] if terms.size else at[:0])
    inside = [d.astype(np.int32) for d in inside]
    scale = length(np.array([values[d] @ values[d] for d in inside]))
    for held in [d[plain[d]] for d in inside], inside:
        for _ in range(epochs):
            order = random.permutation(labels.size)
            for k in range(0, order.size, 128):
                batch = order[k:k + 128]
                size = np.array([held[i].size for i in batch])
                flat = np.concatenate([held[i] for i in batch])
                owner = np.repeat(np.arange(batch.size), size)
                used, local = np.unique(flat, return_inverse=True)
                x = np.repeat(scale[batch], size) * values[flat]
                rows = table[used][local]
                add = lambda w: np.bincount(owner, w, batch.size)  # noqa: B023, E731
                v = rows[:, 1:] * x[:, None]
                total = np.stack([add(v[:, f]) for f in range(factors)], 1)
                squares = add((v ** 2).sum(1))
                y = bias + add(rows[:, 0] * x) + ((total ** 2).sum(1) - squares) / 2
                error = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[batch]
                scaled = (error[owner] * x)[:, None]
                slope = np.concatenate([scaled, scaled * (total[owner] - v)], 1)
                step = np.stack([np.bincount(local, slope[:, f], used.size)
                                 for f in range(1 + factors)], 1) + penalty * table[used]
                grown[used] += step ** 2
                table[used] -= rate * step / np.sqrt(grown[used])
                grown_bias += error.sum() ** 2
                bias -= rate * error.sum() / np.sqrt(grown_bias)
    return Machine(terms, bias, table[:, 0], table[:, 1:].copy(), values)


def train(docs: DataFrame, labels: DataFrame, held_out: int | None = 0, folds: int = 5,
          sample: int = 20_000) -> Machine:
    """Fit on at most about ``sample`` labelled documents, chosen by a hash of doc_id.

    Rows whose crc32(doc_id as text) mod ``folds`` is ``held_out`` are not used. Terms are hashed
    in Spark; one task fits the machine on the bounded sample, in which a doc_id stands once,
    however many rows it has (the one with the least terms as bytes). Several labels of a document
    count as the largest; null labels and ids are not used. Without labelled rows every score is 0.5.
    """
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic"))
    if held_out is not None:
        marked = marked.filter(fold("doc_id", folds) != held_out)
    total = marked.count()
    # The share leaves a margin of some standard deviations below the bound.
    share = min(1.0, max(sample - 4 * sample ** 0.5, 1) / max(total, 1))
    chosen = marked.filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            found = [terms_of(t.as_py(), known).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["toxic"], pa.array(found, pa.binary())],
                ["doc_id", "toxic", "terms"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"], r["terms"]))
        m = fit([np.frombuffer(r["terms"], np.int32) for r in rows],
                np.array([r["toxic"] for r in rows], float)) if rows else Machine(
            np.empty(0, np.int32), 0.0, np.empty(0), np.empty((0, FACTORS)), np.empty(0))
        parts = (m.terms.astype(np.int32), np.float64(m.bias), m.linear, m.factors, m.values)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p.tobytes()], pa.binary()) for p in parts], list("tblfv"))

    model = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         whole_text().alias("text"))
             .join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
             .mapInArrow(hashed, "doc_id long, toxic int, terms binary")
             .groupBy("doc_id", "toxic").agg(F.min("terms").alias("terms")).repartition(1)
             .mapInArrow(learn, "t binary, b binary, l binary, f binary, v binary").first())
    terms, linear = np.frombuffer(model.t, np.int32), np.frombuffer(model.l)
    return Machine(terms, float(np.frombuffer(model.b)[0]), linear,
                   np.frombuffer(model.f).reshape(terms.size, FACTORS), np.frombuffer(model.v))


def fold(column: str, folds: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and, in column ``name`` (replaced if there is one), the probability
    of the toxic label.

    Only whole texts are read; null counts as empty, and an empty text gets the score of a
    document without terms, which is that of the bias alone. Repeated rows are scored each, and an
    empty table gives no rows. The machine is broadcast; it has at most SPACE terms.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict = {}
        for texts in batches:
            found = [np.empty(0)]
            for k in range(0, len(texts), 512):
                found.append(model.value.scores(
                    [terms_of(t, known) for t in texts.iloc[k:k + 512]]))
            yield pd.Series(np.concatenate(found))

    return docs.withColumn(name, scores(whole_text()))


def drop_toxic(docs: DataFrame, machine: Machine, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, with all their columns. Null and empty texts
    have the score of the bias alone, so they stay unless most labelled documents are toxic."""
    name = f"score_{uuid.uuid4().hex}"
    return score(docs, machine, name).filter(F.col(name) < least).drop(name)
