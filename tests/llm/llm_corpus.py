"""Rows for the tests: every kind of text that an operator must bear."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    *(T.StructField(c, T.StringType()) for c in ("row", "key", "score", "cut", "copy", "digest"))])
ODD = "Zé ß'sS'T're<|endoftext|> ½²Ⅷ\x1c\x85 日本İſ\n\t%_-9０"


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join(r.choice(("a", "be", "see", "Éau,", "ñandú", "thing.", "x%"))
                    + str(r.randrange(words)) for _ in range(n))


def corpus():
    """(doc_id, text): copies, near copies, shared passages, odd, empty and very long texts."""
    texts = [prose(i, 30 + 7 * i) for i in range(40)]
    passage = prose(900, 60)
    texts += [f"{prose(100 + i, 40)}\n{passage} {prose(200 + i, 25)}" for i in range(6)]
    base = prose(500, 300).split()
    for i in range(25):
        copy = list(base)
        copy[(i * 11) % 300] = f"new{i}"
        copy[(i * 17 + 5) % 300] = f"other{i}"
        texts.append(" ".join(copy))
    texts += [texts[3], texts[3] + " ", texts[3].replace(" ", "\n"), texts[50], texts[50]]
    texts += ["", None, " \t\n", None, "", "one", "one two three", ODD, ODD * 40]
    texts += ["a" * 700, "ab" * 300 + " tail", "Same line.\n" * 60, "|#$ " * 90]
    texts += [prose(700, 30_000), "x" * 5000 + prose(701, 20_000)]
    rows = list(enumerate(texts))
    rows.append(rows[2])  # a repeated row
    rows.append((None, "no id " * 30))
    return rows
