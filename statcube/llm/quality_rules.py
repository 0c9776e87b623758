"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Each rule looks at a lazily computed view of a text: a signal is computed when the first rule asks for it, and
a text that a rule rejects meets no further rule. ``profile_rules`` runs every rule on a sample of the
documents and measures what it costs and how much it rejects; ``order_rules`` puts the rules that reject
most per second first. A document is kept if no rule rejects it, so the order changes the work and never the
result.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.llm.shared import Query, table, texts_of

#: Rows of the sample on which rules are measured. It sets their order only.
SAMPLE_ROWS = 2000
_SYMBOLS = b"#*$%&|<>"
_NO_SYMBOL = bytes(set(range(256)) - set(_SYMBOLS))
_CONTINUED = bytes(range(0x80, 0xC0))
_SPACE = b"\t\n\x0b\x0c\r "


class TextView:
    """Signals of one whole text, each computed at its first use. Words are runs without ASCII white space."""

    def __init__(self, text: str):
        self.raw = text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.raw.translate(None, _CONTINUED + _SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw.translate(None, _NO_SYMBOL))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip(_SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def codes(self) -> np.ndarray:
        """A number per word, equal for equal words."""
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, len(self.words))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a three-word window that occurs twice or more in the text."""
        codes = self.codes
        if len(codes) < 4:
            return 0
        width = int(codes.max()) + 1
        pairs = codes[:-1] * width + codes[1:]
        if width >= 2**21:  # else the number of a window would not fit 63 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs[:-1] * width + codes[2:]
        ordered = np.sort(windows)
        repeated = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(repeated):
            return 0
        starts = np.flatnonzero(np.isin(windows, repeated))
        covered = np.zeros(len(codes), bool)
        for shift in range(3):
            covered[starts + shift] = True
        return int(covered.sum())

    @cached_property
    def n_shouted(self) -> int:
        """Words of two letters or more in capitals with no small letter."""
        words = [w.decode("utf-8", "replace") for w in self.words]
        return sum(1 for w in words if len(w) > 1 and w.isupper())

    @cached_property
    def top_word_share(self) -> float:
        return max(Counter(self.words).values(), default=0) / max(1, self.n_words)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextView], bool]


@dataclass(frozen=True)
class Measured:
    """What a rule did on the sample; ``seconds`` includes the signals it needs."""

    rows: int
    rejected: int
    seconds: float

    @property
    def rejection_per_cost(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


BASE_RULES = (
    Rule("few_words", lambda v: v.n_words < 50),
    Rule("repeated_windows", lambda v: 100 * v.n_repeat_words > 50 * v.n_words),
)
METHOD_RULES = (
    Rule("symbols", lambda v: 10 * v.n_symbols > 4 * v.n_words),
    Rule("shouting", lambda v: 10 * v.n_shouted > 4 * v.n_words),
    Rule("repeated_lines", lambda v: 10 * v.n_dup_lines > 4 * len(v.lines)),
    Rule("one_word", lambda v: v.top_word_share > 0.4),
    Rule("word_length", lambda v: not 2 * v.n_words <= v.word_chars <= 25 * v.n_words),
)


def profile_rules(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> dict[str, Measured]:
    """Cost and rejections of each rule on a sample of about ``sample_rows`` documents.

    Every rule starts from a fresh view, so that it is charged for all it computes. Only one row per rule
    comes to the driver.
    """
    total = docs.count()
    if not total:
        return {}
    named = list(rules)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, rows = [0.0] * len(named), [0] * len(named), 0
        for batch in batches:
            for value in texts_of(batch.column(0)):
                rows += 1
                for k, rule in enumerate(named):
                    start = time.perf_counter()
                    rejected[k] += rule.rejects(TextView(value))
                    seconds[k] += time.perf_counter() - start
        yield pa.RecordBatch.from_pydict({"name": [r.name for r in named], "n": [rows] * len(named), "rejected": rejected, "seconds": seconds})

    sample = docs.select(F.col(text).alias("__text")).sample(min(1.0, sample_rows / total), seed)
    found = sample.mapInArrow(measure, "name string, n long, rejected long, seconds double").groupBy("name").agg(F.sum("n"), F.sum("rejected"), F.sum("seconds")).collect()
    return {r[0]: Measured(r[1], r[2], r[3]) for r in found if r[1]}


def order_rules(rules: Sequence[Rule], measured: dict[str, Measured]) -> list[Rule]:
    """Rules by falling rejection per second; unmeasured ones stay behind, in their order."""
    return sorted(rules, key=lambda r: -measured[r.name].rejection_per_cost if r.name in measured else 1.0)


def first_rejection(view: TextView, rules: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects; later rules are not run."""
    return next((r.name for r in rules if r.rejects(view)), None)


_SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(text: Column, rules: Sequence[Rule], signals: bool = False) -> Column:
    """Struct with ``rejected_by`` (NULL: kept), and with ``signals`` also the base signals of the text."""
    ordered = list(rules)

    def run(column: pa.Array) -> pa.Array:
        names: list[str | None] = []
        rows: list[list[int]] = []
        for value in texts_of(column):
            view = TextView(value)
            if signals:
                rows.append([getattr(view, s) for s in _SIGNALS])
            names.append(first_rejection(view, ordered))
        arrays = [pa.array(names, pa.string())]
        if signals:
            arrays += [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(_SIGNALS))]
        return pa.StructArray.from_arrays(arrays, ["rejected_by", *_SIGNALS][: len(arrays)])

    fields = ["rejected_by string", *(f"{s} long" for s in (_SIGNALS if signals else ()))]
    return F.arrow_udf(run, f"struct<{', '.join(f.replace(' ', ':') for f in fields)}>")(text)


def quality_cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns; rules in measured order."""
    rules = list(BASE_RULES + METHOD_RULES if rules is None else rules)
    ordered = order_rules(rules, profile_rules(docs, rules, text, sample_rows))
    return docs.filter(judge(F.col(text), ordered)["rejected_by"].isNull())


def quality_signals(docs: DataFrame, identifier: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, base signals, ``base_failed`` and ``kept``.

    A missing text has no words, like an empty one, and fails the base rules. Rows are judged one by one, so repeated rows
    get equal results; other columns are ignored; an empty table gives an empty result. The base signals are asked for
    of every text; the cascade short-circuits the rest.
    """
    rules = list(BASE_RULES + METHOD_RULES)
    ordered = order_rules(rules, profile_rules(docs, rules, text, sample_rows))
    judged = docs.select(F.col(identifier).alias("__id"), judge(F.col(text), ordered, signals=True).alias("__j"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = judged.select("__id", "__j.*")
    return rows.select(F.col("__id").alias(identifier), *_SIGNALS, failed.alias("base_failed"), (~failed & F.col("rejected_by").isNull()).alias("kept"))


def op1(spark, folder):
    return quality_signals(table(spark, folder, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op1_quality_rules": (op1, None)}
