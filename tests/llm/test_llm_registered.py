"""The registered corpus queries on the odd corpus: digests and folds against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from thermolens.llm import queries


@pytest.fixture(scope="module")
def corpus_folder(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("registered"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(60)],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made.no_truncation()
    made.no_padding()
    return made


def sha(data):
    return hashlib.sha256(data).hexdigest()


def sorted_rows(found):
    return sorted(found, key=str)


def fold(doc_id, n):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % n


def test_op2_digests_are_those_of_the_library(spark, corpus_folder, rows, tokenizer):
    expected = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()),
                         sha(decoded.encode())))
    found = [tuple(r) for r in queries.op2_bpe(spark, corpus_folder).collect()]
    assert sorted_rows(found) == sorted_rows(expected)


def test_op4_places_every_id_of_every_row_once(spark, corpus_folder, rows, tokenizer):
    pieces = queries.op4_packing(spark, corpus_folder).collect()
    filled = defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    assert sum(sum(n for _, n in spans) < 2048 for spans in filled.values()) <= 1
    left = Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces)
    for doc_id, text in sorted(rows, key=lambda r: r[0] is None):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        start = 0
        while start < ids.size:
            fitting = [k for k in left if k[:2] == (doc_id, start) and k[4] == ids.size and left[k]
                       and zlib.crc32(ids[start:start + k[2]].tobytes()) == k[3]]
            left[fitting[0]] -= 1
            start += fitting[0][2]
        assert start == ids.size
    assert not sum(left.values())


def test_op7_and_op10_folds_and_ranges(spark, corpus_folder, rows):
    told = queries.op7_language_id(spark, corpus_folder).collect()
    assert Counter(r.doc_id for r in told) == Counter(i for i, _ in rows)
    texts = dict(rows)
    for r in told:
        assert r.held_out == (fold(r.doc_id, 4) == 2 and r.doc_id is not None)
        letters = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert (r.lang_pred in ("en", "fr")) == letters and (r.lang_pred == "und") != letters
        assert 0 <= r.score <= 1
    scored = queries.op10_toxicity(spark, corpus_folder).collect()
    assert Counter(r.doc_id for r in scored) == Counter(i for i, _ in rows)
    for r in scored:
        assert r.held_out == (r.doc_id is not None and fold(r.doc_id, 5) == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op8_removes_what_windows_say(spark, corpus_folder, rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k:k + 200] for _, t in texts for k in range(len(t) - 199))
    expected = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
        expected.append((doc_id, len(t), int(mask.sum()), spans, sha(kept)))
    found = [tuple(r) for r in queries.op8_suffix_dedup(spark, corpus_folder).collect()]
    assert sorted_rows(found) == sorted_rows(expected)


def test_op9_classes_and_links_are_those_of_all_pairs(spark, corpus_folder, rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().split()
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    n = len(rows)
    linked = [[i != j and bool(sets[i]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
               for j in range(n)] for i in range(n)]
    group = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked[i][j] and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    smallest = {g: min((rows[i][0] for i in range(n) if group[i] == g and rows[i][0] is not None),
                       default=None) for g in group}
    expected = [(rows[i][0], smallest[group[i]], sum(linked[i])) for i in range(n)]
    found = [(r.doc_id, r.class_id, r.n_links)
             for r in queries.op9_jaccard_join(spark, corpus_folder).collect()]
    assert sorted_rows(found) == sorted_rows(expected)
