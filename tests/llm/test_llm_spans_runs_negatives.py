"""Personal data, periodic runs and hard negatives."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import check, duck
from conftest import SMALL
from statcube.llm import hard_negatives, periodic_runs, personal_data
from statcube.llm.queries import ORACLES, QUERIES
from statcube.llm.shared import ship_package, table


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship_package(spark)


# Personal data


def passes_luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def base_of(text):
    """Base spans as the plain patterns find them."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


PIECES = "a|b.c|@|x@y.z|1|12|.| |-|+|(|)|4539578763621486|1.2.3.4|255|256|000|é|\U0001f600|_|%|+1 (017) 555-7713|\n|4|0.0|@a.b".split("|")


def odd_texts(count, seed=3):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(count)]
    return [None, "", *made, "a" * 9_000, "1 " * 20_000 + "@", "1." * 20_000, "x@y.zz " * 3_000]


def spans_frame(spark, texts):
    rows = [(k, t, "x", [1]) for k, t in enumerate(texts)] + [(None, "no id 1.2.3.4", "x", None), (2, "twice x@y.zz", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, base array<int>")


def test_base_spans_equal_plain_patterns(spark):
    docs = spans_frame(spark, odd_texts(800)).filter("doc_id IS NULL OR doc_id < 900")
    found = docs.select("text", personal_data.base_spans(F.coalesce("text", F.lit(""))).alias("b")).collect()
    assert len(found) == docs.count()
    for r in found:
        assert [tuple(s) for s in r.b] == base_of(r.text)


def test_spans_hold_the_base_and_do_not_overlap(spark):
    docs = spans_frame(spark, odd_texts(300, 8)[:-4])
    rows = personal_data.find_personal_data(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        spans = [tuple(s) for s in r.spans]
        assert spans == sorted(spans) and {tuple(s) for s in r.base} <= set(spans)
        for kind in range(4):
            own = [s for s in spans if s[1] == kind]
            assert all(a[2] <= b[0] for a, b in zip(own, own[1:]))
    assert personal_data.find_personal_data(docs.limit(0)).count() == 0


def planted_docs(spark, hidden):
    """Texts with cards, numbers that fail the check, phones, and cards that the greedy pattern swallows."""
    rng = random.Random(5)

    def number(good):
        while True:
            d = "".join(rng.choice("0123456789") for _ in range(16))
            if passes_luhn(d) == good:
                return d

    rows = []
    for k in range(160):
        rows.append((k, f"words before {number(True)} and after, then {number(False)} in the end"))
        rows.append((1000 + k, f"call +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} or not"))
        rows.append((2000 + k, f"from {rng.randint(1, 255)}.1.2.{rng.randint(1, 255)} and version {rng.randint(256, 999)}.1.2.3 here"))
    rows += [(5000 + k, f"number {number(False)} {number(True)} thanks") for k in range(hidden)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_model_adds_what_the_base_swallows_and_nothing_else(spark):
    docs = planted_docs(spark, 12)
    found = personal_data.find_personal_data(docs).join(docs, "doc_id").collect()
    added = [(r.text, tuple(s)) for r in found for s in r.spans if tuple(s) not in {tuple(b) for b in r.base}]
    cards = [(text, text[s[0] : s[2]]) for text, s in added if s[1] == 2]
    hidden = {r.text: r.text.split()[2] for r in found if r.doc_id >= 5000}
    assert dict(cards) == hidden and len(cards) == 12
    assert all(s[1] == 2 for _, s in added)


def test_few_labels_add_nothing(spark):
    docs = planted_docs(spark, 3).filter("doc_id >= 5000")
    found = personal_data.find_personal_data(docs).collect()
    assert all(r.base == r.spans for r in found)


def test_boosting_separates_and_calibration_is_monotone():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (400, len(personal_data.FEATURES)))
    y = ((x[:, 2] > 1) ^ (x[:, 4] > 2)).astype(float)
    start, trees = personal_data.boost(x, y, np.ones(len(x)))
    model = personal_data.SpanModel(start, trees, 0.0)
    assert ((model.score(x) > 0) == (y > 0)).mean() > 0.97
    scores, right = np.asarray([1.0, 2, 3, 4, 5]), np.asarray([0.0, 1, 0, 1, 1])
    assert personal_data.threshold_of(scores, right, np.ones(5), 0.9) == 4
    assert personal_data.threshold_of(scores, right, np.ones(5), 0.5) == 2
    assert personal_data.threshold_of(scores, np.zeros(5), np.ones(5), 0.5) == math.inf


def test_personal_data_query(spark):
    query = QUERIES["op11_personal_data"](spark, SMALL)
    assert "Python" not in query._jdf.queryExecution().toString() and "Arrow" not in query._jdf.queryExecution().toString()
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    rows = query.collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_of(texts[r.doc_id])
        names = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(names.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(names.split(",")) <= set(r.spans.split(","))


# Periodic runs


def runs_of(w, least=24, exponent=3):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    some = 0
    for _ in range(600):
        n, k = rng.randint(0, 200), rng.choice([1, 2, 3, 5, 50])
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 30:
                a, p = rng.randrange(n), rng.randint(1, 30)
                for i in range(a + p, min(n, a + rng.randint(20, 150))):
                    w[i] = w[i - p]
        want = runs_of(w)
        some += len(want)
        assert periodic_runs.find_runs(np.asarray(w, np.int32)) == want
        assert periodic_runs.find_runs(np.asarray(w, np.int32), 9, 4) == runs_of(w, 9, 4)
    assert some > 100
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(50, np.int32), 6, 2)


def test_runs_of_words_with_structure():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(1024)]
    for w in (b, thue, [0] * 5000, list(range(40)) * 3, list(range(40)) * 2 + list(range(39))):
        assert periodic_runs.find_runs(np.asarray(w, np.int32)) == runs_of(w)


def test_grammar_derives_the_text():
    rng = random.Random(4)
    w = [rng.randrange(3) for _ in range(500)]
    rules, rest, lengths = periodic_runs.re_pair(w, {0, 200})
    assert sum(lengths) == len(w) and rest[0] == 0 and 200 in rest
    for half, length, places in rules:
        assert 0 < half < length and len(places) > 1
        assert len({tuple(w[i : i + length]) for i in places}) == 1
    assert len(rest) < len(w) / 2


def test_periodic_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    rows = QUERIES["op12_periodic_runs"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = runs_of(words)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)


def test_periodic_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (2, "", 1), (None, "a " * 30, 2), (3, "a b " * 3, 3), (4, "w " * 50_000 + "x" * 300_000, 4), (4, " \t\n\x0b\x0c\r", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs long")
    found = periodic_runs.periodic_runs(docs).collect()
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], len(r.collapsed)) for r in found)
    assert got == [(0, 30, [(0, 30, 1)], 1), (1, 0, [], 0), (2, 0, [], 0), (2, 0, [], 0), (3, 1, [], 12), (4, 0, [], 0), (4, 50_001, [(0, 50_000, 1)], 300_002)]
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# Hard negatives


def mined(rows, positives=5, negatives=10):
    """Brute force in Python's integers over (number, id, label, anchor, vector)."""
    out = []
    for number, anchor_id, label, is_anchor, v in rows:
        if not is_anchor:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), i, other) for k, i, other, _, w in rows if k != number]
        for neg_p, pid, _ in sorted(s[:2] + (0,) for s in score if s[2] == label)[:positives]:
            p = -neg_p
            fit = sorted((s, i) for s, i, other in score if other != label and 30 * p <= -100 * s <= 90 * p)
            out += [(anchor_id, pid, rank, i, p, -s) for rank, (s, i) in enumerate(fit[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize(("scale", "width"), [(1, 5), (40, 6), (30_000_000, 3), (400_000_000, 2)])
def test_hard_negatives_equal_brute_force(spark, scale, width):
    rng = random.Random(scale)
    rows = []
    for k in range(400):
        # A hot vector, a hot label, ties, and ids that repeat.
        v = [1.0 * scale] * width if k % 3 == 0 else [float(rng.randint(-2, 4) * scale) for _ in range(width)]
        rows.append((k // 2 if k % 5 else k, rng.choice([1, 1, 1, 2, 3, -4]), k % 23 == 0, v[: 1 + k % width] if k % 11 == 0 else v))
    frame = spark.createDataFrame(rows, "__id long, __label long, __anchor boolean, __vector array<double>")
    want = mined([(k, i, label, a, [int(x) for x in v]) for k, (i, label, a, v) in enumerate(rows)])
    for blocks, anchor_blocks in ((1, 1), (3, 2), (50, 4)):
        found = hard_negatives.mine_hard_negatives(frame, anchor_blocks=anchor_blocks, blocks=blocks)
        assert sorted(map(tuple, found.collect())) == want
    assert len(want) > 100


def test_hard_negatives_stop_early_and_meet_all():
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(0, 40, (3000, 3)) ** 3 / 1000)
    lists = hard_negatives.SortedLists(vectors, np.arange(3000))
    met = []
    for anchor in vectors[:40]:
        scores = vectors @ anchor
        windows = [(-math.inf, math.inf), (0, scores.max() // 2)]
        best, _, seen = lists.best(anchor, windows, 10, np.arange(3000) % 3 > 0)
        met.append(seen)
        for (low, high), places in zip(windows, best):
            fit = [i for i in range(3000) if i % 3 and low <= scores[i] <= high]
            assert places.tolist() == sorted(fit, key=lambda i: (-scores[i], i))[:10]
    assert np.mean(met) < 2500


def test_hard_negatives_skip_rows_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, [1.0, None], 1), (200, [nan, 1.0], 1), (300, [inf, 1.0], 2), (400, None, 1), (500, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2), (3, [], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    ready = hard_negatives.integer_vectors(frame, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 100 == 0)
    assert sorted(r[0] for r in ready.select("__id").collect()) == [0, 1, 2, 3]
    found = hard_negatives.mine_hard_negatives(ready).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, 256 * 256 + 128 * 256, 128 * 256 + 128 * 128)]
    assert hard_negatives.mine_hard_negatives(ready.limit(0)).count() == 0
    assert hard_negatives.mine_hard_negatives(ready.filter("NOT __anchor")).count() == 0


def test_hard_negatives_query_equals_sql(spark):
    rows, difference = check(spark, duck(SMALL), SMALL, QUERIES["op13_hard_negatives"], ORACLES["op13_hard_negatives"])
    assert difference is None and rows > 0
