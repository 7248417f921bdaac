"""Encoding, packing, quality, language and toxicity against libraries and brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_corpus import ODD
from tokenizers import Tokenizer

from thermolens.llm import bpe, language, pack, quality, toxicity
from thermolens.llm.tokens import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_words_encode_as_the_library_does(library):
    r, bpe_ = random.Random(1), WordBpe(PATH, remember=50)
    pieces = [*ODD, "<|startoftext|>", "'LL", "%%%", "the", "Ünder"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(14)))
        assert bpe_.ids(bpe_.packed(text)).tolist() == library.encode(
            text, add_special_tokens=False).ids


def test_texts_encode_together_as_the_library_does(library):
    r, bpe_ = random.Random(2), WordBpe(PATH, remember=50)
    pieces = [*ODD, *map(chr, range(256)), "<|endoftext|>", "'LL", "'s", "the", "\u3000", "Ω"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(30))) for _ in range(3000)]
    for part in (texts[:1000], texts[1000:], [""], []):
        ids, starts = bpe_.encode(pa.array(["cut off", *part], pa.string())[1:])
        assert [ids[i:j].tolist() for i, j in zip(starts[:-1], starts[1:])] == [
            e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_a_part_is_encoded_once_however_full_the_memory_is(library, monkeypatch):
    bpe_, encoded = WordBpe(PATH, remember=5), Counter()
    pack_ = bpe_._pack
    monkeypatch.setattr(bpe_, "_pack", lambda ids: encoded.update(n=1) or pack_(ids))
    letters = [a + b for a in "bcdfghklmn" for b in "aeiouyrst"]
    text = " ".join([*letters, *(x + "." for x in letters), *map(str.upper, letters)] * 5)
    assert bpe_.ids(bpe_.packed(text)).tolist() == library.encode(
        text, add_special_tokens=False).ids
    assert encoded["n"] == len(letters) + 1


@pytest.mark.parametrize("hot", [1 << 20, 300, 0])
def test_encode_and_decode_equal_the_library(docs, rows, library, hot):
    encoded = bpe.encode(docs, PATH, limit=hot)
    found = Counter((r.doc_id, bytes(r.ids), r.decoded)
                    for r in bpe.decode(encoded, PATH).collect())
    expected = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[i, np.array(ids, "<u4").tobytes(),
                 library.decode(ids, skip_special_tokens=False)] += 1
    assert found == expected


def test_empty_tables(no_docs):
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0
    assert pack.pack(no_docs, PATH).count() == 0
    assert quality.cascade(no_docs, measure_all=True).count() == 0
    langs, prototypes = language.learn(no_docs)
    assert langs == [] and language.predict(no_docs, langs, prototypes).count() == 0


def test_pieces_hold_each_id_once_and_sequences_are_full(docs, rows, library):
    found = [r.asDict() for r in pack.pack(docs.filter("doc_id <> 2"), PATH).collect()]
    for i, text in rows:
        if i in (None, 2):
            continue
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted((p for p in found if p["doc_id"] == i), key=lambda p: p["start"]):
            own = np.array(ids[at:at + p["length"]], "<u4")
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(own.tobytes())
            at += p["length"]
        assert at == len(ids)
    fill = {}
    for p in sorted(found, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == fill.get(p["sequence_id"], 0) and p["length"] > 0
        fill[p["sequence_id"]] = p["offset"] + p["length"]
    assert sorted(fill) == list(range(len(fill)))
    assert all(n == 2048 for s, n in fill.items() if s < len(fill) - 1)


@pytest.mark.parametrize("bits", [1, 2, 4])
def test_hilbert_keys_walk_through_every_cell_by_single_steps(bits):
    side = 1 << bits
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = pack.hilbert_key(cells, bits)
    assert sorted(keys) == list(range(side ** 3))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_near_copies_are_packed_near_each_other(docs):
    pieces = pack.pack(docs.filter("doc_id between 46 and 70 or doc_id < 40"), PATH).collect()
    place = {p.doc_id: p.sequence_id for p in pieces if p.start == 0}
    near = [place[i] for i in range(46, 71)]
    assert len(set(near)) < len(set(place.values()))


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) for k in range(3)
                if windows[tuple(words[i:i + 3])] > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
         len(lines) - len(set(lines)), len(repeated))
    base = n[0] < 50 or 100 * n[4] > 50 * n[0]
    good = not (base or 10 * n[2] > n[0] or 10 * n[3] > 6 * len(lines)
                or not 2 * n[0] <= n[1] <= 25 * n[0])
    return (*n, base, good)


def test_quality_measures_and_verdicts(docs, rows):
    found = quality.cascade(docs, measure_all=True).collect()
    got = Counter((r.doc_id, *(r[m] for m in quality.MEASURES), r.base_failed, r.kept)
                  for r in found)
    assert got == Counter((i, *by_hand(t or "")) for i, t in rows)
    assert all((r.rejected_by is None) == r.kept for r in found)


def test_the_order_of_rules_changes_only_the_reason(docs):
    verdicts = [{(r.doc_id, r.kept) for r in quality.cascade(docs, order=order).collect()}
                for order in (list(quality.RULES), list(quality.RULES)[::-1])]
    assert verdicts[0] == verdicts[1]
    order = quality.rule_order(docs)
    assert sorted(order) == sorted(quality.RULES)


def test_a_rejected_text_is_spared_the_later_measures():
    text = quality.Text("few words")
    assert next(n for n in quality.RULES if quality.RULES[n](text)) == "few_words"
    assert "n_repeat_words" not in vars(text)


def test_language_of_held_out_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = toxicity.fold("doc_id", 4) == 2
    langs, prototypes = language.learn(docs.filter(~held))
    found = language.predict(docs.filter(held), langs, prototypes).collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 %"), (4, "é" * 70)],
                                "doc_id long, text string")
    told = {r.doc_id: r for r in language.predict(odd, langs, prototypes).collect()}
    assert [told[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and told[4].lang_pred in langs


def test_a_gram_vector_is_the_bound_letters():
    grams = language.Grams()
    found, n = grams.of("Ab,b")
    assert n.sum() == 3
    a, b, blank = language.letter_vectors(np.array([97, 98, 32]))
    parts = ((blank, a, b), (a, b, blank), (blank, b, blank))
    expected = sum(np.roll(x, 2) * np.roll(y, 1) * z for x, y, z in parts)
    assert (grams.bundle([(found, n)])[0] == expected).all()


def test_long_texts_are_counted_whole(monkeypatch):
    text = "Ein langer Text, " * 50
    grams = language.Grams()
    whole = grams.bundle([grams.of(text)])[0]
    monkeypatch.setattr(language, "CHUNK", 7)
    assert (grams.bundle([grams.of(text)])[0] == whole).all()


def planted(r, i):
    """A text with filler; toxic if an insult and a group are named together."""
    insult, group = r.random() < 0.5, r.random() < 0.5
    words = [r.choice("abcdefghij") + str(r.randrange(20)) + "w" for _ in range(12)]
    words += ["insultus"] * insult + ["groupus"] * group
    r.shuffle(words)
    return re.sub(r"\d+", lambda m: chr(97 + int(m[0])), " ".join(words)), int(insult and group)


def test_the_machine_learns_a_pair_of_terms():
    r = random.Random(3)
    rows = [planted(r, i) for i in range(3000)]
    terms = [toxicity.terms_of(t, {}) for t, _ in rows]
    machine = toxicity.fit(terms[:2000], np.array([y for _, y in rows[:2000]], float), epochs=20)
    right = [(p >= 0.5) == bool(y) for p, (_, y) in zip(machine.scores(terms[2000:]), rows[2000:])]
    assert np.mean(right) > 0.97
    linear = toxicity.Machine(machine.terms, machine.bias, machine.linear,
                              np.zeros_like(machine.factors))
    alone = [(p >= 0.5) == bool(y) for p, (_, y) in zip(linear.scores(terms[2000:]), rows[2000:])]
    assert np.mean(alone) < np.mean(right)


def test_the_machine_learns_a_pair_whose_terms_alone_tell_nothing():
    r = random.Random(7)
    rows = []
    for k in range(3000):
        insult, group = k % 2, k // 2 % 2  # each stands in half of the documents of both labels
        words = [r.choice("abcdefghij") + r.choice("abcdefghij") + "w" for _ in range(12)]
        words += ["insultus"] * insult + ["groupus"] * group
        rows.append((toxicity.terms_of(" ".join(words), {}), float(insult == group)))
    r.shuffle(rows)
    machine = toxicity.fit([t for t, _ in rows[:2400]], np.array([y for _, y in rows[:2400]]),
                           epochs=20)
    assert np.isin(toxicity.terms_of("insultus groupus", {}), machine.terms).all()
    right = [(p >= 0.5) == bool(y)
             for p, (_, y) in zip(machine.scores([t for t, _ in rows[2400:]]), rows[2400:])]
    assert np.mean(right) > 0.97


def test_scores_of_toxic_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None)], labels.schema))
    machine = toxicity.train(docs, odd)
    found = toxicity.score(docs, machine).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    kept = toxicity.drop_toxic(docs, machine)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in found)
    empty = spark.createDataFrame([(1, None, "x"), (2, "", "y")], "doc_id long, text string, score string")
    assert len({r.score for r in toxicity.score(empty, machine).collect()}) == 1
    blank = toxicity.train(docs, labels.filter("toxic > 5"))
    assert {r.score for r in toxicity.score(empty, blank).collect()} == {0.5}


def test_a_document_with_many_rows_is_fitted_once(spark):
    r = random.Random(4)
    made = [planted(r, i) for i in range(200)]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(made)],
                                   "doc_id long, toxic int")
    texts = [(i, t) for i, (t, _) in enumerate(made)]
    once, often = (toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels,
                                  held_out=None) for rows in (texts, texts + [texts[7]] * 300))
    assert once.bias == often.bias and (once.terms == often.terms).all()
    assert (once.linear == often.linear).all() and (once.factors == often.factors).all()


def test_scores_are_sums_over_all_pairs_of_terms():
    r = np.random.default_rng(6)
    terms = np.sort(r.choice(1000, 50, replace=False)).astype(np.int32)
    machine = toxicity.Machine(terms, -0.3, r.normal(size=50), r.normal(size=(50, 8)) / 3,
                               r.choice([1.0, 0.3], 50))
    documents = [np.sort(r.choice(1000, n, replace=False)).astype(np.int32)
                 for n in (0, 1, 30, 400, 1000)] + [terms[:2]]
    for found, document in zip(machine.scores(documents), documents):
        at = [k for k, t in enumerate(terms) if t in set(document.tolist())]
        x = {k: machine.values[k] * max(sum(machine.values[j] ** 2 for j in at), 1) ** -0.25
             for k in at}
        y = machine.bias + sum(machine.linear[k] * x[k] for k in at) + sum(
            machine.factors[j] @ machine.factors[k] * x[j] * x[k]
            for i, j in enumerate(at) for k in at[:i])
        assert abs(found - 1 / (1 + np.exp(-np.clip(y, -30, 30)))) < 1e-9
