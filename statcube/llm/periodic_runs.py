"""Periodic runs of words, detected on a grammar of each text.

A run is a stretch of words with smallest period ``q`` and a length of at least ``max(LEAST_LENGTH, EXPONENT * q)`` that can't be extended.
Every word of a run lies in a window of ``WINDOW`` words that occurs again, so words outside such windows stay terminals
of their own; the rest is compressed by Re-Pair: the most frequent pair of neighbours becomes a
nonterminal, first come first among equals, until no pair occurs twice.

A run lies whole in the lowest node of the derivation that covers it, and crosses the boundary between that node's two halves.
So the runs across the boundary are computed once per nonterminal, in the text of its first occurrence, and translated to all places at
which it was derived; what is left of the sequence is joined by a balanced tree whose boundaries are looked at once each. A run of period
``q`` across a boundary ``m`` holds one of three squares of length ``2q``: before, across or behind ``m``. Prefix hashes find these for all
``q`` at once, words are then compared one by one, so hashes only propose. Runs that a nonterminal cuts short are merged into the maximal ones of the same period.

The work on a text is one task's, as a text is one value; it needs about 20 bytes a word, and 300 a word of repeated windows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statcube.llm.shared import Query, table

LEAST_LENGTH = 24
EXPONENT = 3
#: A run repeats windows of this length: its length without one period.
WINDOW = LEAST_LENGTH * (EXPONENT - 1) // EXPONENT
SLICE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)

Run = tuple[int, int, int]


def word_numbers(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Number of every word ``[^\\x20\\x09-\\x0D]+`` and the distinct words; a slice of the text at a time."""
    known: dict[bytes, int] = {}
    parts = []
    at = 0
    while at < len(text):
        end = at + SLICE_BYTES
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        words = text[at:end].split()
        for w in words:
            known.setdefault(w, len(known))
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        at = end
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), list(known)


def repeated_stretches(numbers: np.ndarray, window: int = WINDOW, least: int = LEAST_LENGTH) -> list[tuple[int, int]]:
    """Stretches covered by windows that occur more than once, of at least ``least`` words. Equal hashes may add some, none is missed."""
    if len(numbers) < max(window + 1, least):
        return []
    prefix, powers = _prefix_hashes(numbers)
    hashes = (prefix[window:] - prefix[:-window]) * powers[len(numbers) - window :: -1]
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    starts = np.flatnonzero(np.isin(hashes, twice))
    edges = np.zeros(len(numbers) + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    inside = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return [(int(a), int(b)) for a, b in zip(turns[::2], turns[1::2]) if b - a >= least]


def _prefix_hashes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of word value times a power of the base, and the powers; modulo 2**64."""
    powers = np.ones(len(numbers) + 1, np.uint64)
    powers[1:] = _BASE
    powers = np.cumprod(powers, dtype=np.uint64)
    values = (numbers.astype(np.uint64) + np.uint64(1)) * _SPREAD
    values ^= values >> np.uint64(29)
    prefix = np.zeros(len(numbers) + 1, np.uint64)
    np.cumsum(values * powers[:-1], out=prefix[1:])
    return prefix, powers


def re_pair(symbols: list[int], breaks: set[int]) -> tuple[list[tuple[int, int, list[int]]], list[int], list[int]]:
    """Re-Pair of a sequence of terminals below ``len(symbols)``.

    No pair reaches over a place in ``breaks`` (the first of a part). Gives the rules as (length of the left half, length, places of all derived
    occurrences), and the places and lengths of the symbols that are left.
    """
    n = len(symbols)
    symbol = list(symbols)
    following = [-1 if i + 1 in breaks or i + 1 == n else i + 1 for i in range(n)]
    before = [-1 if i in breaks or i == 0 else i - 1 for i in range(n)]
    length = {s: 1 for s in symbol}
    places: dict[tuple[int, int], list[int]] = {}
    for i, j in enumerate(following):
        if j != -1:
            places.setdefault((symbol[i], symbol[j]), []).append(i)
    heap = [(-len(found), turn, pair) for turn, (pair, found) in enumerate(places.items()) if len(found) > 1]
    heapq.heapify(heap)
    turn, fresh = len(places), max(symbol, default=0) + 1
    rules = []
    while heap:
        _, order, pair = heapq.heappop(heap)
        left, right = pair
        valid = [i for i in places[pair] if symbol[i] == left and following[i] != -1 and symbol[following[i]] == right]
        if left == right:
            apart, taken = [], -1
            for i in valid:
                if i != taken:
                    apart.append(i)
                    taken = following[i]
            valid = apart
        places[pair] = valid
        if len(valid) < 2:
            del places[pair]
            continue
        if heap and -heap[0][0] > len(valid):
            heapq.heappush(heap, (-len(valid), order, pair))
            continue
        del places[pair]
        new, fresh = fresh, fresh + 1
        length[new] = length[left] + length[right]
        touched: dict[tuple[int, int], list[int]] = {}
        for i in valid:
            j = following[i]
            k = following[j]
            symbol[i], symbol[j], following[i] = new, -1, k
            h = before[i]
            if h != -1:
                touched.setdefault((symbol[h], new), []).append(h)
            if k != -1:
                before[k] = i
                touched.setdefault((new, symbol[k]), []).append(i)
        for key, found in touched.items():
            if len(found) > 1:
                places[key] = found
                heapq.heappush(heap, (-len(found), turn, key))
                turn += 1
        rules.append((length[left], length[new], valid))
    rest = [i for i in range(n) if symbol[i] != -1]
    return rules, rest, [length[symbol[i]] for i in rest]


class RunFinder:
    """Runs across boundaries of one text."""

    def __init__(self, numbers: np.ndarray, least: int = LEAST_LENGTH, exponent: int = EXPONENT) -> None:
        self.numbers, self.least, self.exponent = numbers, least, exponent
        self.prefix, self.powers = _prefix_hashes(numbers)

    def _squares(self, start: int, end: int, middle: int) -> tuple[np.ndarray, np.ndarray]:
        """Periods and starts of the squares before, across and behind the boundary that hashes propose, by period."""
        most = (end - start) // self.exponent
        periods, starts = [], []
        for shift, widest in ((2, (middle - start) // 2), (1, min(middle - start, end - middle)), (0, (end - middle) // 2)):
            q = np.arange(1, min(most, widest) + 1)
            if not len(q):
                continue
            u = middle - shift * q
            first = self.prefix[u + q] - self.prefix[u]
            second = self.prefix[u + 2 * q] - self.prefix[u + q]
            hit = first * self.powers[q] == second
            periods.append(q[hit])
            starts.append(u[hit])
        if not periods:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, u = np.concatenate(periods), np.concatenate(starts)
        order = np.argsort(q, kind="stable")
        return q[order], u[order]

    def _extent(self, at: int, q: int, start: int, end: int) -> tuple[int, int] | None:
        """The maximal stretch of period ``q`` around the square at ``at``, within the node; None if the words differ."""
        w = self.numbers
        if not np.array_equal(w[at : at + q], w[at + q : at + 2 * q]):
            return None
        low, high, step = at, at + 2 * q, 64
        while high < end:
            most = min(step, end - high)
            differ = np.flatnonzero(w[high : high + most] != w[high - q : high - q + most])
            if len(differ):
                high += int(differ[0])
                break
            high += most
            step *= 2
        step = 64
        while low > start:
            most = min(step, low - start)
            differ = np.flatnonzero(w[low - most : low] != w[low - most + q : low + q])
            if len(differ):
                low -= most - 1 - int(differ[-1])
                break
            low -= most
            step *= 2
        return low, high

    def across(self, start: int, middle: int, end: int) -> list[Run]:
        """Runs (start, end, period) across ``middle`` of the node that spans ``start`` to ``end``, as far as it reaches."""
        if end - start < self.least:
            return []
        found = []
        q, u = self._squares(start, end, middle)
        while len(q):
            period, at = int(q[0]), int(u[0])
            extent = self._extent(at, period, start, end)
            if extent is None:
                q, u = q[1:], u[1:]
                continue
            low, high = extent
            if high - low >= max(self.least, self.exponent * period) and low < middle < high:
                found.append((low, high, period))
            # Squares inside this stretch with a multiple of its period say the same.
            other = (q % period != 0) | (u < low) | (u + 2 * q > high)
            q, u = q[other], u[other]
        return found


def find_runs(numbers: np.ndarray, least: int = LEAST_LENGTH, exponent: int = EXPONENT) -> list[Run]:
    """All runs as (start, length, period), by start, then period."""
    if exponent < 3:
        raise ValueError("a run holds a square at the boundary only if it has three periods")
    window = least - least // exponent
    stretches = repeated_stretches(numbers, window, least)
    if not stretches:
        return []
    finder = RunFinder(numbers, least, exponent)
    found: list[np.ndarray] = []
    at = np.concatenate([np.arange(a, b) for a, b in stretches])
    sizes = np.asarray([b - a for a, b in stretches])
    breaks = set((np.cumsum(sizes) - sizes).tolist())
    rules, rest, lengths = re_pair(numbers[at].tolist(), breaks)
    at_list = at
    for half, length, places in rules:
        if length < least:
            continue
        first = int(at_list[places[0]])
        runs = finder.across(first, first + half, first + length)
        if runs:
            moved = at_list[np.asarray(places)] - first
            for low, high, q in runs:
                found.append(np.stack([np.full(len(moved), q), low + moved, high + moved], 1))

    # The symbols that are left, part by part, under a balanced tree.
    ends = [int(at_list[i]) + size for i, size in zip(rest, lengths)]
    opening = [k for k, i in enumerate(rest) if i in breaks] + [len(rest)]
    todo = [(a, b) for a, b in zip(opening, opening[1:])]
    starts = [int(at_list[i]) for i in rest]
    while todo:
        a, b = todo.pop()
        if b - a < 2 or ends[b - 1] - starts[a] < least:
            continue
        middle = (a + b) // 2
        runs = finder.across(starts[a], starts[middle], ends[b - 1])
        if runs:
            found.append(np.asarray([(q, low, high) for low, high, q in runs], np.int64))
        todo += [(a, middle), (middle, b)]
    if not found:
        return []
    return _maximal(np.concatenate(found))


def _maximal(intervals: np.ndarray) -> list[Run]:
    """Drop what lies inside another interval of the same period; rows are (period, start, end)."""
    order = np.lexsort((-intervals[:, 2], intervals[:, 1], intervals[:, 0]))
    kept = []
    last_period, last_end = -1, -1
    for period, start, end in intervals[order].tolist():
        if period == last_period and end <= last_end:
            continue
        last_period, last_end = period, end
        kept.append((start, end - start, period))
    return sorted(kept, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those that no run holds behind its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def collapse(numbers: np.ndarray, words: list[bytes], runs: list[Run]) -> bytes:
    """The kept words, joined by one space."""
    if runs:
        numbers = numbers[kept_words(len(numbers), runs)]
    return b" ".join(map(words.__getitem__, numbers.tolist()))


def periodic_runs(
    docs: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    least: int = LEAST_LENGTH,
    exponent: int = EXPONENT,
    prepare: Callable[[object, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """id, ``n_words``, ``runs`` (array of start, length, period; by start, then period) and ``collapsed`` text, per row of ``docs``.

    ``prepare`` may change the word numbers of a text (given its id) before the search. A missing text has no words and an empty collapsed text,
    as has an empty one. Rows are kept one by one, repeated ids and missing ids too; no other column is read; an empty table gives
    an empty result. Texts are taken whole, whatever their length.
    """
    id_kind = docs.schema[identifier].dataType.simpleString()
    run_kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, at = batch.num_rows, 0
            while at < size:
                sizes, runs, texts, start, held = [], [], [], at, 0
                while at < size and held < 16 * SLICE_BYTES:
                    numbers, words = word_numbers(batch.column(1)[at].as_py() or b"")
                    if prepare is not None:
                        numbers = prepare(batch.column(0)[at].as_py(), numbers)
                    found = find_runs(numbers, least, exponent)
                    sizes.append(len(numbers))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    texts.append(collapse(numbers, words, found))
                    held += len(texts[-1])
                    at += 1
                arrays = [batch.column(0).slice(start, at - start), pa.array(sizes, pa.int64()), pa.array(runs, run_kind), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["__id", "n_words", "runs", "collapsed"])

    read = docs.select(F.col(identifier), F.col(text).cast("binary"))
    kinds = f"__id {id_kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    found = read.mapInArrow(detect, kinds)
    return found.select(F.col("__id").alias(identifier), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def planted_period(doc_id: int | None, numbers: np.ndarray) -> np.ndarray:
    """Let the end of every tenth text (by the crc32 of its id) repeat with a period; a missing id changes nothing."""
    n = len(numbers)
    if doc_id is None or not n:
        return numbers
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return numbers
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    changed = numbers.copy()
    changed[a:] = numbers[a + np.arange(n - a) % p]
    return changed


def op12(spark, folder):
    found = periodic_runs(table(spark, folder, "documents"), prepare=planted_period)
    # Runs come by start, then period, so the first of equal exponent stays.
    steeper = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    found = found.withColumn("best", F.aggregate("runs", none, lambda best, r: F.when(steeper(best, r), r).otherwise(best)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, tuple[Query, str | None]] = {"op12_periodic_runs": (op12, None)}
