"""Quality rules as a short-circuit cascade."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermolens.llm.common import whole_text

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BLANKS, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"


class Text:
    """The measures of one text, each computed when first asked for."""

    def __init__(self, text: str) -> None:
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        first: dict = {}
        repeated = bytearray(len(w))
        for i, window in enumerate(windows):
            j = first.setdefault(window, i)
            if j != i:
                repeated[i:i + 3] = repeated[j:j + 3] = b"\x01\x01\x01"
        return sum(repeated)


Rule = Callable[[Text], bool]
#: Each says whether a text fails. The first two are the base.
RULES: dict[str, Rule] = {
    "few_words": lambda t: t.n_words < 50,
    "repeated_words": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "repeated_lines": lambda t: 10 * t.n_dup_lines > 6 * len(t.lines),
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 25 * t.n_words,
}
BASE = ("few_words", "repeated_words")


def rule_order(docs: DataFrame, rules: dict[str, Rule] = RULES, sample: int = 2000) -> list[str]:
    """Rules by rejections per second, the best first.

    Cost and selectivity are taken on about ``sample`` documents spread by a hash: every rule is
    timed on a fresh text, so it pays for all it needs. Without documents the order is as given.
    """
    total = docs.count()
    share = min(1.0, sample / max(total, 1))

    def time_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, failed = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        for batch in batches:
            for text in batch["text"]:
                for name, rule in rules.items():
                    fresh = Text(text.as_py())
                    began = time.perf_counter()
                    failed[name] += rule(fresh)
                    spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array(rules), pa.array(spent.values()), pa.array(failed.values(), pa.int64())],
            ["rule", "spent", "failed"])

    text = whole_text()
    found = (docs.select(text.alias("text"))
             .filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
             .mapInArrow(time_rules, "rule string, spent double, failed long")
             .groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("failed").alias("failed"))
             .collect())
    gain = {r.rule: r.failed / max(r.spent, 1e-9) for r in found}
    return sorted(rules, key=lambda name: -gain.get(name, 0))


def cascade(docs: DataFrame, rules: dict[str, Rule] = RULES, order: list[str] | None = None,
            measure_all: bool = False) -> DataFrame:
    """doc_id, kept and rejected_by (the first rule in order that a text failed, else null).

    Rules run in the order of ``rule_order`` until one rejects, so a rejected text is spared the
    costlier measures; the order does not change ``kept``. ``measure_all`` completes the measures
    (MEASURES) of every text afterwards and adds base_failed.

    A null or empty text has no words and fails ``few_words``; repeated rows are judged each; an
    empty table gives no rows; other columns are not read.
    """
    order = order or rule_order(docs, rules)
    extra = [f"{m} long" for m in MEASURES] + ["base_failed boolean"] if measure_all else []

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, reasons, more = [], [], []
            for raw in batch["text"]:
                text = Text(raw.as_py())
                reason = next((name for name in order if rules[name](text)), None)
                kept.append(reason is None)
                reasons.append(reason)
                if measure_all:
                    more.append([getattr(text, m) for m in MEASURES]
                                + [any(rules[name](text) for name in BASE if name in rules)])
            columns = [batch["doc_id"], pa.array(kept, pa.bool_()), pa.array(reasons, pa.string())]
            if measure_all:
                columns += [pa.array(c, pa.bool_() if i == len(MEASURES) else pa.int64())
                            for i, c in enumerate(zip(*more) if more else [[]] * 6)]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "kept", "rejected_by", *(x.split()[0] for x in extra)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")) \
        .mapInArrow(judge, ", ".join(["doc_id long", "kept boolean", "rejected_by string", *extra]))
