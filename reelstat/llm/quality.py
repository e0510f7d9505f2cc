"""Quality rules as a short-circuit cascade.

Each rule rejects a text for one property. On a bounded sample, every rule's
cost (time a text) and selectivity are measured, and the rules are put in
order of rejections per cost among the sample texts that earlier rules leave.
A block of texts then passes the rules in this order, and a rule looks only at
what is still alive. A text is kept if no rule rejects it, so the order
changes the time, never the result.
"""

from __future__ import annotations

import re
import time
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from reelstat.llm.common import hashes, smallest_hashes, text_blocks, words

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_NOT_LETTERS = bytes(b for b in range(33, 127) if not chr(b).isalpha())
_LINES = re.compile("\n")


class Text:
    """A text and its measures, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return words(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in _LINES.split(self.text) if x.strip(_SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a 5-word window which the text holds twice or more."""
        if self.n_words < 6:
            return 0
        w = hashes(self.words)
        window = np.zeros(len(w) - 4, np.uint64)
        for i in range(5):
            window = window * np.uint64(0x9E3779B97F4A7C15) + (w[i:len(w) - 4 + i] ^ (w[i:len(w) - 4 + i] >> np.uint64(29)))
        order = np.argsort(window)
        ranked = window[order]
        same = ranked[1:] == ranked[:-1]
        if not same.any():
            return 0
        twice = np.zeros(len(w) + 1, np.int64)
        again = np.zeros(len(window), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        np.add.at(twice, np.flatnonzero(again), 1)
        np.add.at(twice, np.flatnonzero(again) + 5, -1)
        return int((np.cumsum(twice) > 0).sum())

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _UPPER))

    @cached_property
    def n_lower(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _LOWER))

    @cached_property
    def n_not_letters(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _NOT_LETTERS))


#: Base rules first; name -> whether it rejects.
BASE_RULES = {
    "few_words": lambda t: t.n_words < 10,
    "repetition": lambda t: 100 * t.n_repeat_words > 20 * t.n_words,
}
RULES = BASE_RULES | {
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "duplicate_lines": lambda t: 10 * t.n_dup_lines > 3 * len(t.lines),
    "word_length": lambda t: t.word_chars > 20 * t.n_words or t.word_chars < 2 * t.n_words,
    "upper_case": lambda t: t.n_upper > t.n_lower,
    "not_letters": lambda t: 2 * t.n_not_letters > t.word_chars,
}


def order_rules(sample: list[str | None], names: list[str]) -> list[str]:
    """The rules by rejections per second among the sample texts that the rules before leave; ties by name."""
    alive, left, order = list(sample), sorted(names), []
    while left:
        gain = {}
        for name in left:
            texts = [Text(t) for t in alive]
            began = time.perf_counter()
            rejected = sum(bool(RULES[name](t)) for t in texts)
            gain[name] = rejected / max(time.perf_counter() - began, 1e-9)
        best = max(left, key=lambda n: gain[n])
        order.append(best)
        left.remove(best)
        alive = [t for t in alive if not RULES[best](Text(t))]
    return order


def sample_texts(docs: DataFrame, text: str = "text", size: int = 300) -> list[str | None]:
    """At most ``size`` different texts, those whose hashes are smallest."""
    return smallest_hashes(docs, text, size)


def cascade(docs: DataFrame, order: list[str], text: str = "text", measures: bool = False) -> DataFrame:
    """The rows with ``kept`` and ``failed_rule`` (the first in ``order`` that rejects; null: kept) in front,
    and with ``measures`` the base columns of every text too, at the cost of computing them for all.

    A null or empty text has no words. Repeated rows are judged one by one;
    equally named columns are replaced.
    """
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"] if measures else []
    front = "kept boolean, failed_rule string" + "".join(f", {c} long" for c in base) + (", base_failed boolean" if measures else "")
    new = StructType.fromDDL(front)
    rest = [c for c in docs.columns if c not in new.names]

    def run(batches):
        for batch in batches:
            failed, columns, bad = [], {c: [] for c in base}, []
            for _, _, texts in text_blocks(batch, text):
                judged = [Text(t) for t in texts]
                first: list[str | None] = [None] * len(judged)
                alive = range(len(judged))
                for name in order:
                    rejects = RULES[name]
                    rejected = {i for i in alive if rejects(judged[i])}
                    for i in rejected:
                        first[i] = name
                    alive = [i for i in alive if i not in rejected]
                failed += first
                for c in base:
                    columns[c] += [getattr(t, c) for t in judged]
                if measures:
                    bad += [any(rule(t) for rule in BASE_RULES.values()) for t in judged]
            out = [pa.array([f is None for f in failed], pa.bool_()), pa.array(failed, pa.string())]
            out += [pa.array(columns[c], pa.int64()) for c in base] + ([pa.array(bad, pa.bool_())] if measures else [])
            yield pa.RecordBatch.from_arrays(out + [batch.column(batch.schema.get_field_index(c)) for c in rest], new.names + rest)

    kept = docs.select(*rest)
    return kept.mapInArrow(run, StructType(new.fields + kept.schema.fields))
