"""Tokenizer alignment against comparison of all token pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from llm_corpus import DOCS
from thermolens.llm import align
from thermolens.llm.queries import op11_token_alignment

PATHS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def both():
    return align.Tokenizers(*PATHS)


def token_spans(both, text):
    """(id, start, end) of the tokens by A and by B; nothing where bytes differ."""
    if not text:
        return [], []
    out = []
    for ids, of in ((both.a.encode(" " + text, add_special_tokens=False).ids, both.bytes_a),
                    (both.b.encode(text), both.bytes_b)):
        spans, at = [], 0
        for i in ids:
            spans.append((i, at, at + len(of[i])))
            at += len(of[i])
        if b"".join(of[i] for i in ids) != b" " + text.encode():
            return [], []
        out.append(spans)
    return out


def by_hand(both, text):
    a, b = token_spans(both, text)
    links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
    ends = {e for *_, e in a} & {e for *_, e in b}
    groups, at = [], 0
    for end in sorted(ends):
        groups.append("|".join(",".join(str(i) for i, s, e in side if at < e <= end)
                               for side in (a, b)))
        at = end
    return len(a), len(b), groups, Counter(links)


def odd_texts():
    r = random.Random(4)
    parts = ("the ", "Théa", "日本", "\n", "  ", "<s>", "<|endoftext|>", "<0x0A>", "😀", "a", "ing",
             "12", "é", "\x00", " ", "İ", "ß")
    return ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(150)] + [
        "", "a", " ", "▁", "x▁y", "<unk>", "﷽", "Ａ"]


@pytest.mark.parametrize("width", [7, align.LANE])
def test_texts_are_aligned_as_by_hand(both, width):
    texts = odd_texts()
    found = align.align_texts(both, texts, width)
    for i, text in enumerate(texts):
        n_a, n_b, groups, links = by_hand(both, text)
        assert (found.n_a[i], found.n_b[i], found.n_groups[i]) == (n_a, n_b, len(groups))
        assert found.groups[i] == ";".join(groups)
        assert found.n_links[i] == sum(links.values())
        pairs = [(int(p) // len(both.bytes_b), int(p) % len(both.bytes_b)) for p in found.pairs[i]]
        assert dict(zip(pairs, found.times[i].tolist())) == links
    assert found.n_a[-4] == found.n_a[-5] == 0 and (found.n_a > 0).sum() > 140
    assert align.align_texts(both, []).groups == []


def test_merging_of_random_cuts_in_any_lanes():
    r = np.random.default_rng(3)
    for width in (1, 3, 50, 10_000):
        lengths = np.array([1, 200, 3, 0, 57])
        total = int(lengths.sum())
        ends = [np.unique(np.concatenate((np.cumsum(lengths)[lengths > 0], r.choice(
            np.arange(1, total), 90, replace=False)))) for _ in range(2)]
        a, b, cut_a, cut_b = align.merge(*ends, *align.lanes(lengths, width))
        starts = [np.concatenate(([0], e[:-1])) for e in ends]
        linked = (starts[0][:, None] < ends[1]) & (starts[1] < ends[0][:, None])
        assert sorted(zip(a.tolist(), b.tolist())) == [tuple(x) for x in np.argwhere(linked)]
        common = np.intersect1d(*ends)
        assert (ends[0][cut_a] == common).all() and (ends[1][cut_b] == common).all()


@pytest.mark.parametrize("cuts", [True, False])
@pytest.mark.parametrize("remember", [0, 20, 1 << 18])
def test_pieces_encode_as_whole_texts_do(remember, cuts, monkeypatch):
    monkeypatch.setattr(align, "REMEMBER", remember)
    own, r = align.Tokenizers(*PATHS), random.Random(6)
    assert own.cuts
    own.cuts = cuts
    parts = (" ", " ", "  ", "\n", "\t", "\x85", "\u3000", "\x1c", "\u180e", "a", "the", "b.", "'s",
             "▁", "日本", "\u0301", "<s>", "<|endoftext|>", "<0x0A>", "x" * 70, "\x00")
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(900)]
    texts += [f"a{chr(c)}  b{chr(c)} {chr(c)} {chr(c)}'s " for c in range(0x3001) if c % 3 or c < 256]
    for some in (texts[:300], texts[300:], [""], []):
        a, n_a, b, n_b = own.encode(some)
        at_a, at_b = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))
        for i, text in enumerate(some):
            told = [[k for k, *_ in side] for side in token_spans(own, text)]
            assert [a[at_a[i]:at_a[i + 1]].tolist(), b[at_b[i]:at_b[i + 1]].tolist()] == told


def test_a_tokenizer_gets_a_repeated_piece_once():
    class Counted:
        def __init__(self, model):
            self.model, self.characters = model, 0

        def encode(self, texts, **options):
            self.characters += sum(map(len, texts))
            return self.model.encode(texts, **options)

    own = align.Tokenizers(*PATHS)
    own.b = Counted(own.b)
    text = "The cat sat on the mat, one of the cats. " * 200
    found = align.align_texts(own, [text, text])
    assert found.groups[0] == found.groups[1] and found.n_b[0] > 1000
    assert own.b.characters < 200


@pytest.mark.parametrize("limit", [1 << 20, 50, 0])
def test_query_equals_counts_by_hand(spark, docs, rows, both, tmp_path, limit, monkeypatch):
    kept = [r for r in rows if r[1] is None or len(r[1]) < 4000]
    docs.filter("text is null or length(text) < 4000").write.parquet(
        str(tmp_path / "documents.parquet"))
    summary = align.summary
    monkeypatch.setattr(align, "summary", lambda *x: summary(*x, limit=limit))
    found = sorted((tuple(r) for r in op11_token_alignment(spark, str(tmp_path)).collect()), key=str)
    told = [(i, *by_hand(both, t)) for i, t in kept]
    counts, most = Counter(), Counter()
    for *_, links in told:
        counts.update(links)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    expected = [
        (i, n_a, n_b, len(groups), sum(links.values()),
         sum(n for (p, q), n in links.items() if counts[p, q] == most[q]),
         sum(n * counts[p] for p, n in links.items()),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for i, n_a, n_b, groups, links in told]
    assert found == sorted(expected, key=str)


def test_long_texts_and_empty_table(spark, both, rows):
    text = max((t for _, t in rows if t), key=len)
    found = align.align_texts(both, [text, text])
    assert found.groups[0] == found.groups[1] and found.n_links[0] > 50_000
    assert (found.n_groups == len(found.groups[0].split(";"))).all()
    assert align.summary(spark.createDataFrame([], DOCS), *PATHS).count() == 0
