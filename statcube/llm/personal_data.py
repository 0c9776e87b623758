"""Personal data by boosted trees over proposed spans; DataFrame operations only.

Kinds are email, ip, card and phone. Fixed patterns with a check (Luhn, parts up to 255, number of digits) find the base spans, which
always stay. Generators of high recall propose overlapping spans besides: every window of up to ``GROUPS`` neighbouring groups
of digits that may be a card, a phone number or an address, and mail addresses with spaces or ``(at)`` and ``(dot)``. So a card behind another number,
which the greedy base pattern swallows and drops, is proposed on its own.

Every proposal has small whole-number features of its format (digits, groups, check, shape, lead) and its context (neighbouring characters, cue words). Gradient
boosting learns one model a kind from all proposals whose label is sure: those that are base spans, against those that break the
format. The labelled proposals of the whole corpus are counted per combination of features, so what comes to the driver is bounded by the number of combinations
(at most ``COMBINATIONS``), not by the corpus. A quarter of the values is held back: on it scores are calibrated by pooling adjacent violators, and the threshold of a kind is
the least score whose calibrated precision reaches ``PRECISION``; a kind without one adds nothing. Of overlapping proposals of a kind above its threshold the best stays, base spans first.

Patterns are written with possessive quantifiers and look-behind, equal in what they match to the plain ones, so that time is
linear in the text and no repetition recurses. Places are code points; sums run in blocks, linear in the number of matches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.llm.shared import Query, table
from statcube.sources.scratch import materialize

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
GROUPS = 8
ROUNDS, RATE, PRECISION = 24, 0.3, 0.98
#: Labelled proposals of a class that a kind needs, in either part, to be learned.
LEAST_LABELLED = 5

_LOCAL = r"[A-Za-z0-9._%+-]"
_NAME = r"[A-Za-z0-9-]"
# \G: a match may begin where the last one ended, amid characters of the same class.
BASE_PATTERNS = (
    rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))"
_ADDRESS = rf"^{_PART}(?:\.{_PART}){{3}}$"
_AT = r"\x20?(?:@|\((?i:at)\)|\[(?i:at)\])\x20?"
_DOT = r"\x20?(?:\.|\((?i:dot)\)|\[(?i:dot)\])\x20?"
LOOSE_EMAIL = rf"(?<!{_LOCAL}){_LOCAL}++{_AT}{_NAME}++(?:{_DOT}{_NAME}++)*+"
DIGIT_GROUP = r"\+?\(?[0-9]++\)?"
CUES = (
    r"(?i)(?:phone|fon|tel|call|fax|mobil|appel)",
    r"(?i)(?:card|visa|carte|karte|tarjeta|credit)",
    r"(?i)(?:mail|contact|courri|correo)",
    r"(?i)(?:\bip\b|host|server|addr|adres)",
    r"(?i)(?:order|invoice|ref|isbn|token|key|hash|serial|version|\bid\b|\bno\b)",
)
FEATURES = ("digits", "groups", "check", "shape", "lead", "before", "after", "cue")
#: Values of each feature; their product bounds what is counted per combination.
SIZES = (20, GROUPS + 1, 2, 3, 4, 6, 6, len(CUES) + 1)
COMBINATIONS = math.prod(SIZES) * len(KINDS)

_SPAN = "struct<start:bigint,kind:int,end:bigint>"
_PLACED = "struct<start:bigint,end:bigint,value:string,gap:string,next:string>"
_PROPOSED = "struct<" + "start:bigint,kind:int,end:bigint,value:string," + ",".join(f"{f}:int" for f in FEATURES) + ",broken:boolean>"
_BLOCK = 512


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap, as (start, end, value, gap, next): code points, what stands since the match before, the next character.

    Longer gaps are cut to their last 24 characters.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = let(pieces, lambda p: F.filter(F.arrays_zip(found.alias("value"), p.alias("gap"), F.slice(p, 2, 2**31 - 1).alias("next")), lambda z: z["value"].isNotNull()))

    def step(done: Column, z: Column) -> Column:
        start = done["at"] + F.char_length(z["gap"])
        end = start + F.char_length(z["value"])
        one = F.struct(start.alias("start"), end.alias("end"), z["value"].alias("value"), F.right(z["gap"], F.lit(24)).alias("gap"), F.left(z["next"], F.lit(1)).alias("next"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one.cast(_PLACED))).alias("out"))

    def block(done: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(done["at"].alias("at"), _empty(_PLACED).alias("out")), step)
        return let(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(done["out"], F.array(r["out"])).alias("out")))

    def placed(z: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(z) - 1) / _BLOCK).cast("int"))
        parts = F.transform(firsts, lambda b: F.slice(z, b * _BLOCK + 1, F.lit(_BLOCK)))
        opening = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<array<{_PLACED}>>").alias("out"))
        return F.when(F.size(z) == 0, _empty(_PLACED)).otherwise(F.aggregate(parts, opening, block, lambda done: F.flatten(done["out"])))

    return let(both, placed)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""

    def weighed(total: Column, i: Column) -> Column:
        d = digits.substr(F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), weighed) % 10 == 0


def _passes(kind: int, value: Column) -> Column:
    size = F.length(digits_of(value))
    if kind == IP:
        return value.rlike(_ADDRESS)
    if kind == CARD:
        return F.when(size.between(14, 19), luhn(digits_of(value))).otherwise(False)
    if kind == PHONE:
        return size.between(10, 15)
    return F.lit(True)


_PRESENT = ("@", ".", None, "+")


def _span(kind: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")).cast(_SPAN)


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def _valid(kind: int) -> Callable[[Column], Column]:
    return lambda m: _passes(kind, m["value"])


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end), by start, then kind."""
    parts = []
    for kind, (pattern, sign) in enumerate(zip(BASE_PATTERNS, _PRESENT)):
        present = F.contains(text, F.lit(sign)) if sign else F.lit(True)
        if kind in (IP, CARD):
            present &= text.rlike("[0-9]")
        spans = F.transform(F.filter(matches(text, pattern), _valid(kind)), _span(kind))
        parts.append(F.when(present, spans).otherwise(_empty(_SPAN)))
    return F.array_sort(F.concat(*parts))


def _character(c: Column) -> Column:
    """Class of a neighbouring character: none or space, digit, letter, quote or sign, stop, other."""
    rules = ((r"^\s?$", 0), (r"^[0-9]$", 1), (r"^\p{L}$", 2), (r"^[=:#\"'/_@+-]$", 3), (r"^[.,;!?()]$", 4))
    out = F.lit(5)
    for pattern, number in reversed(rules):
        out = F.when(c.rlike(pattern), number).otherwise(out)
    return out


def _cue(gap: Column) -> Column:
    out = F.lit(0)
    for number, pattern in reversed(list(enumerate(CUES, 1))):
        out = F.when(gap.rlike(pattern), number).otherwise(out)
    return out


def _proposal(kind: int, start: Column, end: Column, value: Column, gap: Column, after: Column, broken: Column, **features: Column) -> Column:
    features = {"before": _character(F.right(gap, F.lit(1))), "after": _character(after), "cue": _cue(gap), **features}
    return F.struct(
        start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value"),
        *[F.least(features[f].cast("int"), F.lit(n - 1)).alias(f) for f, n in zip(FEATURES, SIZES)],
        F.coalesce(broken, F.lit(False)).alias("broken"),
    ).cast(_PROPOSED)


def _window_proposals(window: Column) -> Column:
    """Proposals of a window of digit groups: of (start, end, value, gaps, gap, next, groups, chained)."""
    value, gaps, groups = window["value"], window["gaps"], window["groups"]
    digits = digits_of(value)
    size = F.length(digits)
    common = dict(start=window["start"], end=window["end"], value=value, gap=window["gap"], after=window["next"])
    even = F.when(groups == 1, 0).when(value.rlike(r"^[0-9]{4}(?:[\x20-][0-9]{4})*+$"), 1).otherwise(2)
    card = _proposal(
        CARD, **common, broken=~luhn(digits), digits=size, groups=groups, check=luhn(digits).cast("int"), shape=even, lead=F.when(value.startswith("0"), 1).otherwise(0)
    )
    lead = F.when(value.startswith("+"), 3).when(value.startswith("("), 2).when(value.startswith("0"), 1).otherwise(0)
    dotted = gaps.rlike(r"^(?:<\.>)++$")
    phone = _proposal(
        PHONE, **common, broken=(lead == 0) & (dotted | window["chained"] | luhn(digits)), digits=size, groups=groups, check=(lead == 3).cast("int"),
        shape=F.when(value.contains("("), 1).when(dotted, 2).otherwise(0), lead=lead,
    )
    fits = value.rlike(_ADDRESS)
    part = F.array_max(F.transform(F.split(value, r"\."), F.length))
    address = _proposal(
        IP, **common, broken=~fits | window["chained"], digits=size, groups=groups, check=fits.cast("int"), shape=F.when(part <= 3, 0).otherwise(1), lead=F.when(value.rlike(r"(?:^|\.)0[0-9]"), 1).otherwise(0)
    )
    plain = value.rlike(r"^[0-9]++(?:[\x20-][0-9]++)*+$")
    none = _empty(_PROPOSED)
    return F.concat(
        F.when(plain & size.between(14, 19), F.array(card)).otherwise(none),
        F.when(size.between(10, 15) & value.rlike("[0-9]$") & ((lead >= 2) | value.startswith("00") | (groups >= 3)), F.array(phone)).otherwise(none),
        F.when((groups == 4) & dotted & value.rlike(r"^[0-9.]++$"), F.array(address)).otherwise(none),
    )


def _windows(groups: Column) -> Column:
    """All proposals from windows of neighbouring digit groups."""
    near = r"^(?:<[\x20().-]{0,2}>)*+$"

    def window(i: Column, k: Column) -> Column:
        def described(s: Column) -> Column:
            inner = F.transform(F.slice(s, F.lit(2), F.greatest(k - 1, F.lit(0))), lambda t: t["gap"])
            value = F.concat(s[0]["value"], F.array_join(F.transform(F.slice(s, F.lit(2), F.greatest(k - 1, F.lit(0))), lambda t: F.concat(t["gap"], t["value"])), ""))
            follow = F.when(i + k <= F.size(groups), F.element_at(groups, F.least(i + k, F.size(groups)))["gap"])
            return F.struct(
                s[0]["start"].alias("start"),
                F.element_at(s, -1)["end"].alias("end"),
                value.alias("value"),
                F.array_join(F.transform(inner, lambda g: F.concat(F.lit("<"), g, F.lit(">"))), "").alias("gaps"),
                s[0]["gap"].alias("gap"),
                F.element_at(s, -1)["next"].alias("next"),
                k.alias("groups"),
                (((i > 1) & s[0]["gap"].rlike(r"^[\x20.-]?$")) | F.coalesce(follow.rlike(r"^[\x20.-]?$"), F.lit(False))).alias("chained"),
            )

        return let(F.slice(groups, i, k), described)

    def from_group(i: Column) -> Column:
        wide = F.transform(F.sequence(F.lit(1), F.least(F.lit(GROUPS), F.size(groups) - i + 1)), lambda k: window(i, k))
        return F.flatten(F.transform(F.filter(wide, lambda w: w["gaps"].rlike(near) & (F.length(w["value"]) <= 64)), _window_proposals))

    return F.when(F.size(groups) == 0, _empty(_PROPOSED)).otherwise(F.flatten(F.transform(F.sequence(F.lit(1), F.size(groups)), from_group)))


def _mail_proposals(m: Column) -> Column:
    value = m["value"]
    labels = F.size(F.split(F.regexp_replace(value, rf"^{_LOCAL}++{_AT}", ""), _DOT))
    last = F.length(F.regexp_extract(value, rf"({_NAME}++)$", 1))
    spelled = F.when(value.contains(" "), 2).when(value.contains("(") | value.contains("["), 1).otherwise(0)
    return _proposal(
        EMAIL, m["start"], m["end"], value, m["gap"], m["next"], broken=labels < 2, digits=last, groups=labels, check=(labels > 1).cast("int"),
        shape=spelled, lead=F.when(value.rlike(r"^[._%+-]"), 1).otherwise(0),
    )


def proposals(text: Column) -> Column:
    """Overlapping spans with their features, of all kinds."""
    mail = F.when(text.rlike(r"@|(?i:[(\[]at[)\]])"), F.transform(matches(text, LOOSE_EMAIL), _mail_proposals)).otherwise(_empty(_PROPOSED))
    numbers = F.when(text.rlike(r"[0-9]"), let(matches(text, DIGIT_GROUP), _windows)).otherwise(_empty(_PROPOSED))
    return F.concat(mail, numbers)


@dataclass(frozen=True)
class Tree:
    """Two levels of questions ``feature <= value``; ``leaves`` are for (yes, yes), (yes, no), (no, yes), (no, no)."""

    tests: tuple[tuple[int, int], tuple[int, int], tuple[int, int]]
    leaves: tuple[float, float, float, float]

    def of(self, x: np.ndarray) -> np.ndarray:
        (f, a), (g, b), (h, c) = self.tests
        first = x[:, f] <= a
        return np.where(first, np.where(x[:, g] <= b, *self.leaves[:2]), np.where(x[:, h] <= c, *self.leaves[2:]))

    def column(self, get: Callable[[str], Column]) -> Column:
        (f, a), (g, b), (h, c) = [(get(FEATURES[f]), v) for f, v in self.tests]
        yy, yn, ny, nn = map(F.lit, self.leaves)
        return F.when(f <= a, F.when(g <= b, yy).otherwise(yn)).otherwise(F.when(h <= c, ny).otherwise(nn))


@dataclass(frozen=True)
class SpanModel:
    """Score: the log-odds ``start`` plus all trees; spans from ``threshold`` on are taken."""

    start: float
    trees: tuple[Tree, ...]
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.of(x) for t in self.trees), np.zeros(len(x)))


def _split(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[float, int, int]:
    """(gain, feature, value) of the best question for some rows; ties: first feature, least value."""
    best = (0.0, 0, int(x[rows, 0].max(initial=0)))
    total_g, total_h = gradient[rows].sum(), weight[rows].sum()
    for f in range(x.shape[1]):
        for v in np.unique(x[rows, f])[:-1]:
            yes = rows[x[rows, f] <= v]
            g, h = gradient[yes].sum(), weight[yes].sum()
            gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
            if gain > best[0] + 1e-9:
                best = (float(gain), f, int(v))
    return best


def boost(x: np.ndarray, y: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> tuple[float, tuple[Tree, ...]]:
    """Gradient boosting of the logistic loss with trees of two levels, on counted rows."""
    counts = counts / counts.sum() * min(float(counts.sum()), 1000.0)  # so that the shrinkage of leaves doesn't depend on the corpus
    share = float((counts * y).sum() / counts.sum())
    start = math.log((share + 1e-6) / (1 - share + 1e-6))
    margin = np.full(len(x), start)
    trees = []
    everything = np.arange(len(x))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = counts * (y - p), counts * p * (1 - p)
        _, f, a = _split(x, gradient, weight, everything)
        tests, leaves = [(f, a)], []
        for side in (everything[x[:, f] <= a], everything[x[:, f] > a]):
            _, g, b = _split(x, gradient, weight, side)
            tests.append((g, b))
            for rows in (side[x[side, g] <= b], side[x[side, g] > b]):
                leaves.append(float(rate * gradient[rows].sum() / (weight[rows].sum() + 1)) if len(rows) else 0.0)
        trees.append(Tree(tuple(tests), tuple(leaves)))
        margin += trees[-1].of(x)
    return start, tuple(trees)


def threshold_of(scores: np.ndarray, y: np.ndarray, counts: np.ndarray, precision: float = PRECISION) -> float:
    """The least score from which on the calibrated share of right spans reaches ``precision``; infinite if none does.

    Calibration pools adjacent violators, so that the share rises with the score.
    """
    pools: list[list[float]] = []  # score, right, all
    for s in np.unique(scores):
        at = scores == s
        pools.append([float(s), float((counts * y)[at].sum()), float(counts[at].sum())])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, right, total = pools.pop()
            pools[-1][1] += right
            pools[-1][2] += total
    return min((s for s, right, total in pools if right >= precision * total), default=math.inf)


def learn_spans(extracted: DataFrame, precision: float = PRECISION) -> dict[int, SpanModel]:
    """One model a kind from all labelled proposals, counted per combination of features."""
    of = extracted.select("__base", F.explode("__proposed").alias("p"))
    right = F.array_contains("__base", F.struct(F.col("p.start"), F.col("p.kind"), F.col("p.end")).cast(_SPAN))
    label = F.when(right, 1).when(F.col("p.broken"), 0)
    held = F.pmod(F.xxhash64("p.value"), F.lit(4)) == 0
    counted = of.select(F.col("p.kind").alias("kind"), *[F.col(f"p.{f}").alias(f) for f in FEATURES], held.alias("held"), label.alias("label"))
    rows = counted.filter("label IS NOT NULL").groupBy(*counted.columns).count().collect()
    models = {}
    for kind in range(len(KINDS)):
        own = sorted(r for r in rows if r["kind"] == kind)
        parts = []
        for held_back in (False, True):
            part = [r for r in own if r["held"] == held_back]
            x = np.asarray([[r[f] for f in FEATURES] for r in part], np.int64).reshape(-1, len(FEATURES))
            parts.append((x, np.asarray([r["label"] for r in part], float), np.asarray([r["count"] for r in part], float)))
        (x, y, n), (x_held, y_held, n_held) = parts
        if min((n * y).sum(), (n_held * y_held).sum(), (n * (1 - y)).sum()) < LEAST_LABELLED:
            continue
        start, trees = boost(x, y, n)
        model = SpanModel(start, trees, math.inf)
        found = threshold_of(model.score(x_held), y_held, n_held, precision)
        if found < math.inf:
            models[kind] = SpanModel(start, trees, found - 1e-9)
    return models


def _chosen(kind: int, model: SpanModel) -> Column:
    """Spans of one kind that the model adds."""
    scored = "struct<start:bigint,better:double,end:bigint,added:boolean>"

    def one(p: Column) -> Column:
        score = F.lit(model.start)
        for tree in model.trees:
            score = score + tree.column(lambda f: p[f])
        return F.struct(p["start"].alias("start"), (-score).alias("better"), p["end"].alias("end"), F.lit(True).alias("added")).cast(scored)

    def fixed(b: Column) -> Column:
        return F.struct(b["start"].alias("start"), F.lit(-math.inf).alias("better"), b["end"].alias("end"), F.lit(False).alias("added")).cast(scored)

    def step(done: Column, p: Column) -> Column:
        last = done["last"]
        apart = last.isNull() | (p["start"] >= last["end"])
        kept = F.when(apart & last["added"], F.concat(done["out"], F.array(last))).otherwise(done["out"])
        return F.struct(F.when(apart | (p["better"] < last["better"]), p).otherwise(last).alias("last"), kept.alias("out"))

    def finish(done: Column) -> Column:
        ended = F.when(done["last"]["added"], F.concat(done["out"], F.array(done["last"]))).otherwise(done["out"])
        return F.transform(ended, _span(kind))

    good = F.filter(F.transform(F.filter("__proposed", _of_kind(kind)), one), lambda p: -p["better"] >= model.threshold)
    base = F.transform(F.filter("__base", _of_kind(kind)), fixed)
    opening = F.struct(F.lit(None).cast(scored).alias("last"), _empty(scored).alias("out"))
    return F.aggregate(F.array_sort(F.concat(base, good)), opening, step, finish)


def added_spans(models: dict[int, SpanModel]) -> Column:
    """Spans of ``__proposed`` above the threshold of their kind; of overlapping ones the best stays, base spans first."""
    # Most texts have no proposal of a kind.
    parts = [F.when(F.exists("__proposed", _of_kind(k)), _chosen(k, m)).otherwise(_empty(_SPAN)) for k, m in models.items()]
    return F.concat(*parts) if parts else _empty(_SPAN)


def find_personal_data(docs: DataFrame, identifier: str = "doc_id", text: str = "text", precision: float = PRECISION) -> DataFrame:
    """id, ``base`` and ``spans`` (arrays of start, kind, end; by start, then kind) per row of ``docs``.

    ``kind`` is a place in ``KINDS``, places are code points with the end exclusive. ``spans`` holds ``base`` and what the model adds. A missing
    text counts as empty and has no spans. Rows are kept one by one, repeated and missing ids too; no other column is read; texts are taken whole; an
    empty table, or one with too few labelled proposals, adds nothing.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    extracted = docs.select(F.col(identifier).alias("__id"), base_spans(whole).alias("__base"), proposals(whole).alias("__proposed"))
    extracted = materialize(extracted, "spans")
    models = learn_spans(extracted, precision)
    return extracted.select(
        F.col("__id").alias(identifier),
        F.col("__base").alias("base"),
        F.array_sort(F.array_distinct(F.concat(F.col("__base"), added_spans(models)))).alias("spans"),
    )


def joined(spans: str, kinds: Sequence[str] = KINDS) -> Column:
    """Spans as text, ``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11(spark, folder):
    found = find_personal_data(table(spark, folder, "documents"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op11_personal_data": (op11, None)}
