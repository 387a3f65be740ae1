"""Quality rules as a short-circuit cascade.

Each rule rejects texts by a few measures. On a bounded sample (``SAMPLE_ROWS`` rows) every rule is timed and its share of
rejected texts counted; the rules then run in the order of rejection per cost and a text's cascade ends at the first rule
that rejects it. The order decides what is computed, never the verdict, so sample and clock change no result.

Words are runs of characters other than space and ``\\t`` to ``\\r``. Null and empty texts have no words: all measures are zero and the
text is rejected as too short. Rows that repeat get the same answer; an empty table gives an empty table; other columns pass
through. Texts are measured whole, one at a time; windows of words are compared exactly.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import replaced, replaced_schema, slices

SAMPLE_ROWS = 400
WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


class Facts:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes part at the six ASCII white spaces alone

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
        """Words in windows of eight that occur twice or more: windows are numbered by doubling, so equal numbers are equal words."""
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in self.words], dtype=np.int64)
        if len(known) == self.n_words:
            return 0
        size = 1
        while size < WINDOW:
            _, ids = np.unique(ids[:-size] * self.n_words + ids[size:], return_inverse=True)
            size *= 2
        starts = (np.bincount(ids)[ids] > 1).astype(np.int64)
        edges = np.zeros(self.n_words + 1, dtype=np.int64)
        edges[:n] += starts
        edges[WINDOW:] -= starts
        return int((np.cumsum(edges[:-1]) > 0).sum())

    @cached_property
    def letters(self) -> tuple[int, int]:
        """Upper-case letters and cased letters."""
        upper = sum(map(str.isupper, self.text))
        return upper, upper + sum(map(str.islower, self.text))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts], bool]


#: the base rules, which every caller gets
BASE = (
    Rule("too_short", lambda f: f.n_words < 20),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > 30 * f.n_words),
)
#: rules of the method
MORE = (
    Rule("symbols", lambda f: 10 * f.n_symbols > 3 * f.n_words),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > len(f.lines)),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 15 * f.n_words),
    Rule("capitals", lambda f: f.letters[1] >= 40 and 2 * f.letters[0] > f.letters[1]),
)
RULES = BASE + MORE
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimates(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[Estimate]:
    """Seconds a text and share of rejected texts of each rule, each from scratch."""
    out = []
    for rule in rules:
        began = time.perf_counter()
        hits = sum(rule.rejects(Facts(t)) for t in texts)
        n = max(1, len(texts))
        out.append(Estimate(rule, (time.perf_counter() - began) / n, hits / n))
    return out


def order(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The most rejection for the time first; the cheapest first of those that reject nothing here."""
    return tuple(e.rule for e in sorted(estimates(texts, rules), key=lambda e: (-e.worth, e.seconds)))


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text") -> list[str | None]:
    """About ``rows`` texts from all over ``docs``, the same ones at every run: those whose hash is under the share."""
    key = F.xxhash64("doc_id" if "doc_id" in docs.columns else text)
    share = min(1.0, rows / max(1, docs.count()))
    return [r[0] for r in docs.where(F.pmod(key, F.lit(1 << 30)) < share * (1 << 30)).select(text).collect()]


def verdict(facts: Facts, ordered: tuple[Rule, ...]) -> str | None:
    """The name of the first rule that rejects, or null."""
    return next((r.name for r in ordered if r.rejects(facts)), None)


def cascade(docs: DataFrame, names: list[str] | None = None, measures: bool = False, text: str = "text") -> DataFrame:
    """``docs`` with ``kept``; ``names`` is the order of the rules in ``RULES``, by default that of a sample of ``docs``.

    ``measures`` adds ``MEASURES`` and ``base_failed``; they are then computed for every text, rejected or not. A column of the
    input that has the name of an added one is replaced by it.
    """
    names = names or [r.name for r in order(sample(docs, text=text))]
    fields = [T.StructField(m, T.LongType()) for m in MEASURES] + [T.StructField("base_failed", T.BooleanType())] if measures else []
    fields.append(T.StructField("kept", T.BooleanType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_name = {r.name: r for r in RULES}
        ordered = tuple(by_name[n] for n in names)
        for batch in slices(batches, text):
            found = []
            for t in batch.column(text).to_pylist():
                f = Facts(t)
                kept = verdict(f, ordered) is None
                found.append((*(getattr(f, m) for m in MEASURES), any(r.rejects(f) for r in BASE), kept) if measures else (kept,))
            columns = [pa.array(c, pa.bool_() if x.dataType == T.BooleanType() else pa.int64()) for c, x in zip(zip(*found), fields)]
            yield replaced(batch, columns, fields)

    return docs.mapInArrow(run, replaced_schema(docs, fields))
