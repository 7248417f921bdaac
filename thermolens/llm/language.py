"""Language identification by hyperdimensional profiles."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermolens.llm.common import whole_text

DIMENSIONS = 1024
#: Grams of a batch are bundled in blocks of so many, which bounds the working memory.
BLOCK = 4096
#: Characters of text handled at a time.
CHUNK = 1 << 20
_LETTER = np.array([chr(i).isalpha() for i in range(0x110000)])


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """A random vector of signs per letter, drawn from the code point alone."""
    out = np.empty((letters.size, DIMENSIONS), np.float32)
    for i, c in enumerate(letters.tolist()):
        bits = np.random.default_rng(c).bytes(DIMENSIONS // 8)
        out[i] = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.float32) * 2 - 1
    return out


class Grams:
    """Counts of letter trigrams, and their vectors: the letters' vectors, shifted by the place
    in the trigram and multiplied. Runs of letters are padded by a blank on both sides."""

    def __init__(self) -> None:
        self.letters = np.array([32])
        self.vectors = letter_vectors(self.letters)
        self.place = np.zeros(0x110000, np.int32)

    def _learn(self, codes: np.ndarray) -> None:
        new = np.unique(codes[self.place[codes] == 0])
        new = new[new != 32]
        if new.size:
            self.place[new] = self.letters.size + np.arange(new.size)
            self.letters = np.concatenate((self.letters, new))
            self.vectors = np.concatenate((self.vectors, letter_vectors(new)))

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Trigram codes of a whole text and their counts."""
        codes, counts = [], []
        for k in range(0, max(len(text), 1), CHUNK):
            # A chunk overlaps the next by two characters, so no trigram is lost or doubled.
            part = (" " if k == 0 else "") + text[k:k + CHUNK + 2]
            part += " " if k + CHUNK + 2 >= len(text) else ""
            raw = np.frombuffer(part.lower().encode("utf-32-le"), np.uint32)
            raw = np.where(_LETTER[raw], raw, 32)
            self._learn(raw)
            p = self.place[raw].astype(np.int64)
            gram = p[:-2] << 42 | p[1:-1] << 21 | p[2:]
            gram = gram[(p[1:-1] != 0)]
            found, n = np.unique(gram, return_counts=True)
            codes.append(found)
            counts.append(n)
            if k + CHUNK + 2 >= len(text):
                break
        if len(codes) == 1:
            return codes[0], counts[0]
        found, at = np.unique(np.concatenate(codes), return_inverse=True)
        return found, np.bincount(at, np.concatenate(counts), found.size).astype(np.int64)

    def bind(self, grams: np.ndarray) -> np.ndarray:
        first, second, third = (self.vectors[grams >> s & 0x1FFFFF] for s in (42, 21, 0))
        return np.roll(first, 2, 1) * np.roll(second, 1, 1) * third

    def bundle(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The sum of the gram vectors of each text, weighted by count."""
        out = np.zeros((len(found), DIMENSIONS), np.float32)
        every = np.unique(np.concatenate([g for g, _ in found]))
        for k in range(0, every.size, BLOCK):
            block = every[k:k + BLOCK]
            counts = np.zeros((len(found), block.size), np.float32)
            for i, (grams, n) in enumerate(found):
                low, high = np.searchsorted(grams, (block[0], block[-1] + 1))
                counts[i, np.searchsorted(block, grams[low:high])] = n[low:high]
            out += counts @ self.bind(block)
        return out


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """One prototype per value of ``lang``: the bundle of all its texts, scaled to length one.

    Every row with a non-null lang counts. Tasks send one vector per language, which are added up
    by language and dimension; there are as many prototypes as languages, 10,000 at most.
    """
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = Grams(), {}
        for batch in batches:
            for k in range(0, len(batch), 512):
                part = batch.slice(k, 512)
                counts: dict[str, list] = {}
                for lang, text in zip(part["lang"].to_pylist(), part["text"]):
                    counts.setdefault(lang, []).append(grams.of(text.as_py()))
                for lang, own in counts.items():
                    every, at = np.unique(np.concatenate([g for g, _ in own]),
                                          return_inverse=True)
                    n = np.bincount(at, np.concatenate([n for _, n in own]), every.size)
                    bundled = grams.bundle([(every, n)])[0].astype(float)
                    sums[lang] = sums.get(lang, 0) + bundled
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.string()), pa.array([v.tolist() for v in sums.values()],
                                                   pa.list_(pa.float64()))], ["lang", "vector"])

    parts = docs.filter(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), whole_text().alias("text")).mapInArrow(
        bundle, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("dim", "value")).groupBy(
        "lang", "dim").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v")).limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 values of lang")
    rows.sort(key=lambda r: r.lang)
    table = np.array([[x.value for x in r.v] for r in rows]).reshape(len(rows), DIMENSIONS)
    return [r.lang for r in rows], table / np.maximum(
        np.linalg.norm(table, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    """All columns of ``docs``, lang_pred and score, the cosine with the nearest prototype (0 to 1).

    Only whole texts are read. A text that is null or has no letter, or any text when nothing was
    learned, is ``und`` with score 0; columns of these names are replaced. Of equal cosines the
    language first in order is taken.
    """
    model = docs.sparkSession.sparkContext.broadcast((langs, prototypes.astype(np.float32)))

    @F.pandas_udf("lang string, score double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, table = model.value
        grams = Grams()
        for texts in batches:
            lang, score = [], []
            for k in range(0, len(texts), 128):
                found = [grams.of(t or "") for t in texts.iloc[k:k + 128]]
                vectors = grams.bundle(found)
                cosines = vectors @ table.T / np.maximum(
                    np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                for (own, _), row in zip(found, cosines):
                    known = own.size > 0 and len(names) > 0
                    lang.append(names[int(row.argmax())] if known else "und")
                    score.append(float(np.clip(row.max(), 0, 1)) if known else 0.0)
            yield pd.DataFrame({"lang": lang, "score": score})

    mark = f"told_{uuid.uuid4().hex}"
    told = docs.withColumn(mark, nearest(F.col("text").cast("string")))
    return told.withColumns({"lang_pred": F.col(f"{mark}.lang"),
                             "score": F.col(f"{mark}.score")}).drop(mark)
