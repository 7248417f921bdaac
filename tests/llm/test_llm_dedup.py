"""Exact, near and passage dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermolens.llm import common, exact, near, suffix
from thermolens.llm.components import components


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_keeps_the_longest_of_equal_texts(spark, docs, rows):
    found = exact.fresh_index(spark).dedup(docs).collect()
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for i, text in rows:
        groups[squeezed(text)].append((-len(text or ""), i is None, i))
    expected = {}
    for i, text in rows:
        group = groups[squeezed(text)]
        expected[i] = (min(group)[2], len(group),
                       hashlib.sha256(squeezed(text).encode()).hexdigest())
    for r in found:
        assert (r.keep_id, r.group_size, r.text_sha256) == expected[r.doc_id]
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.keep_id == r.doc_id for r in found if r.kept)


def test_a_second_batch_is_compared_with_the_index(spark, docs, rows):
    index = exact.fresh_index(spark)
    first = index.dedup(docs.filter("doc_id < 60")).collect()
    second = index.dedup(docs.filter("doc_id >= 30")).collect()
    held = {r.text_sha256: r.keep_id for r in first}
    assert {r.doc_id for r in second if r.kept}.isdisjoint({r.doc_id for r in first if r.kept})
    for r in second:
        if r.text_sha256 in held:
            assert not r.kept and r.keep_id == held[r.text_sha256]
    again = exact.DigestIndex(spark, index.path).dedup(docs).collect()
    assert not any(r.kept for r in again if r.doc_id is not None)


def test_exact_keep_returns_whole_rows(spark, docs, rows, no_docs):
    kept = exact.fresh_index(spark).keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({squeezed(t) for _, t in rows})
    assert exact.fresh_index(spark).dedup(no_docs).count() == 0


def test_keep_loses_no_text_of_a_shuffled_table(spark, folder):
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k) for k in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        docs = docs.withColumn("wide", F.repeat("text", 3)).dropDuplicates(["doc_id"])
        texts = Counter(squeezed(r.text) for r in docs.select("text").collect())
        kept = [squeezed(r.text) for r in exact.fresh_index(spark).keep(docs).select(
            "text").collect()]
        assert sorted(kept) == sorted(texts)
        once = near.keep_one(docs).select("doc_id").collect()
        assert len(once) == len(set(once)) > 0.5 * len(texts)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_only_rows_straight_from_files_are_not_written_again(spark, docs):
    assert common.steady(docs) is docs
    files = set(docs.inputFiles())
    for same in (docs.filter("doc_id > 3"), docs.withColumn("x", F.length("text"))):
        assert set(common.steady(same).inputFiles()) == files
    for other in (docs.repartition(3), docs.limit(5), docs.distinct(), spark.range(5)):
        assert set(common.steady(other).inputFiles()).isdisjoint(files)


def test_a_batch_can_be_repeated_by_its_name(spark, docs):
    index = exact.fresh_index(spark, docs)
    first = index.dedup(docs, "monday").collect()  # say its result was never written
    assert sorted(map(tuple, index.dedup(docs, "monday").collect()), key=str) == sorted(
        map(tuple, first), key=str)
    assert spark.read.parquet(index.path).count() == len({r.text_sha256 for r in first})
    assert not any(r.kept for r in index.dedup(docs, "tuesday").collect())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index")]
    assert exact.DigestIndex(spark, index.path, index.buckets).buckets == index.buckets
    with pytest.raises(ValueError, match="buckets"):
        exact.DigestIndex(spark, index.path, index.buckets + 1)
    assert exact.DigestIndex(spark, f"{index.path}-2", expected=10 ** 8).buckets == 100


def word_sets(rows):
    def shingles(text):
        words = (text or "").encode().split()
        return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) \
            if words else frozenset()
    return [shingles(t) for _, t in rows]


@pytest.mark.parametrize("block", [256, 4])
def test_near_duplicates_equal_all_pairs(docs, rows, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    sets = word_sets(rows)
    links, parent = Counter(), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and len(a & b) >= 0.8 * len(a | b):
                links[i] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    expected = Counter(
        (rows[i][0], min((rows[j][0] for j in range(len(rows)) if root(j) == root(i)
                          and rows[j][0] is not None), default=None), links[i])
        for i in range(len(rows)))
    found = near.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in found) == expected
    assert sum(r.keeper for r in found) == len({root(i) for i in range(len(rows))})
    assert max(links.values()) > 15


def test_near_keep_one_and_empty_table(docs, no_docs):
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert near.near_duplicates(no_docs).count() == 0
    assert near.keep_one(kept).count() == kept.count()


def test_prefixes_shorten_until_the_target():
    assert near.prefix_depth(0.8, 0.9) == near.LEVELS
    assert near.prefix_depth(0.8, 0.9999) == 6
    assert near.prefix_depth(0.5, 0.9999) < near.prefix_depth(0.8, 0.9999)


def cut_by_hand(rows):
    seen = Counter()
    raw = [(t or "").encode() for _, t in rows]
    for x in raw:
        seen.update(x[i:i + 200] for i in range(len(x) - 199))
    for (doc_id, _), x in zip(rows, raw):
        covered = np.zeros(len(x), bool)
        for i in range(len(x) - 199):
            if seen[x[i:i + 200]] > 1:
                covered[i:i + 200] = True
        edges = np.diff(np.concatenate(([0], covered, [0])).astype(int))
        yield (doc_id, int(covered.sum()), int((edges == 1).sum()),
               np.frombuffer(x, np.uint8)[~covered].tobytes())


@pytest.mark.parametrize("hot,batches,step", [(4096, 2, 1 << 19), (1, 3, 1000)])
def test_passages_equal_brute_force(docs, rows, monkeypatch, hot, batches, step):
    monkeypatch.setattr(suffix, "HOT_SUFFIX", hot)
    monkeypatch.setattr(suffix, "STEP", step)
    found = suffix.remove_repeats(docs, batches).select(
        "doc_id", "cut.n_removed", "cut.n_spans", "cut.kept").collect()
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted([(r[0], r[1], r[2], bytes(r[3])) for r in found], key=key) == sorted(
        cut_by_hand(rows), key=key)


def test_cut_texts_keeps_rows_and_columns(docs, rows, no_docs):
    cut = suffix.cut_texts(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    by_hand = Counter((i, k.decode(errors="ignore")) for i, _, _, k in cut_by_hand(rows))
    assert Counter((r.doc_id, r.text or "") for r in cut.collect()) == by_hand
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)
    assert suffix.cut_texts(no_docs).count() == 0


def test_levels_grow_geometrically(spark, docs):
    index = suffix.SuffixIndex(spark, 4)
    numbered = docs.select("text").na.fill("").selectExpr(
        "monotonically_increasing_id() AS row", "text")
    for i in range(5):
        index.add(numbered.filter(f"pmod(row, 5) = {i}"))
    assert sorted(rank for rank, _ in index.levels) == [0, 2]


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(path + star + [(5, 5), (None, 3), (7000, 6999), (1, 2)],
                                  "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)} | {
        7000: 6999, 6999: 6999}
    assert components(edges.filter("a = b")).count() == 0
