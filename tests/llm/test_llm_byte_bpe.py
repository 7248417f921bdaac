"""Byte-level BPE against the library, and its parts against plain search."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from llm_corpus import DOCS, ODD
from thermolens.llm import byte_bpe
from thermolens.llm.queries import op13_byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)


def hostile():
    r = random.Random(5)
    parts = ("a", "ab", " ", "  ", "\n", "'s", "'ll", "é", "日本", "😀", "1", "22", "!", "\x1c", "\x85",
             " ", "<|endoftext|>", " the", "the", "aaa", "\x00", "٣", "İ", "ſ")
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(50))) for _ in range(2000)]
    return texts + ["", "a" * 3000, " " * 5000, "ab" * 20_000, ODD * 100,
                    "x" * 200_000 + " y " * 150_000]


def test_perfect_hash_has_one_place_for_each_key(bpe):
    table = bpe.table
    assert sorted(table.key_at) == list(range(len(bpe.tokens)))
    found = table.find(table.raw, table.starts, table.starts + table.sizes)
    assert (found == np.arange(len(bpe.tokens))).all()
    others = [t + b"\x00q" for t in bpe.tokens[::7]] + [b""]
    raw = np.frombuffer(b"".join(others), np.uint8)
    ends = np.cumsum([len(t) for t in others])
    assert (table.find(raw, ends - [len(t) for t in others], ends) < 0).all()
    assert byte_bpe.PerfectHash([]).find(raw, ends[:1] * 0, ends[:1]).tolist() == [-1]


def test_ids_are_those_of_the_library(bpe, library):
    texts = hostile()
    for text, ids in zip(texts, bpe.encode_all(texts)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_merging_equals_plain_search_for_the_lowest_rank(bpe):
    r = random.Random(9)
    for _ in range(300):
        word = bytes(r.choice(b"thein \xc3\xa9") for _ in range(r.randrange(1, 30)))
        parts = [bytes([b]) for b in word]
        while True:
            pairs = [(bpe.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                     if a + b in bpe.ranks]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert byte_bpe.merge_bytes(word, bpe.ranks) == [bpe.ranks[p] for p in parts]


def test_query_equals_the_library(spark, docs, rows, library, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted((tuple(r) for r in op13_byte_bpe(spark, str(tmp_path)).collect()), key=str)
    expected = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids),
                         hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)


def test_empty_table_null_ids_and_unknown_ids(spark, library):
    none = spark.createDataFrame([], DOCS)
    encoded = byte_bpe.encode(none, PATH, public_tokenizers.PATTERN)
    assert byte_bpe.decode(encoded, PATH).count() == 0
    ids = library.encode_ordinary(" the é")
    rows = spark.createDataFrame([(1, ids), (None, []), (3, None), (4, [-1, 60_000, *ids])],
                                 "doc_id long, ids array<int>")
    told = {r.doc_id: r.decoded for r in byte_bpe.decode(rows, PATH).collect()}
    assert {k: v and bytes(v) for k, v in told.items()} == {
        1: " the é".encode(), None: b"", 3: None, 4: " the é".encode()}
