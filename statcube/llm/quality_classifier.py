"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage of ``PASSAGE_WORDS`` words is encoded from
measures of its surface and hashed character pairs; a hidden layer makes its representation h. Gated attention
weighs the passages, a = softmax(w . (tanh(V h) * sigmoid(U h))), and a logistic output scores the weighted representation. All
layers are learned together from document labels by Adam.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.llm.shared import Query, id_fold, table, texts_of

PASSAGE_WORDS = 64
#: Labelled documents from which the model is learned, about (a random sample of all labels).
SAMPLE_ROWS = 3000
PAIR_BUCKETS = 512
#: Parts of the labels, of which the sample takes as many as it needs.
_SHARES = 1 << 40
PROJECTED = 24
HIDDEN = 24
ATTENTION = 16
_MEASURES = 12
#: Passages that are encoded at a time.
_SLICE = 4096
_SIZE = _MEASURES + PROJECTED
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _flags(characters: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[[ord(c) for c in characters]] = True
    return flags


_CLASSES = np.stack([
    _flags("#*$%&|<>"),
    _flags("!?"),
    _flags(".,;:"),
    _flags("0123456789"),
    _flags("|"),
    _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    _flags("abcdefghijklmnopqrstuvwxyz"),
]).astype(np.float32)


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(3).normal(size=(PAIR_BUCKETS, PROJECTED)).astype(np.float32)


def _repeated_windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Which three-word windows occur more than once; ``codes`` are numbers of words below ``width``."""
    pairs = codes[:-1].astype(np.int64)
    pairs *= width
    pairs += codes[1:]
    if width >= 2**21:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * width
    windows += codes[2:]
    ordered = np.sort(windows)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    found = np.zeros(len(windows), bool)
    if len(twice):
        for at in range(0, len(windows), _SLICE * PASSAGE_WORDS):
            part = windows[at : at + _SLICE * PASSAGE_WORDS]
            place = np.minimum(np.searchsorted(twice, part), len(twice) - 1)
            found[at : at + len(part)] = twice[place] == part
    return found


def passages(text: str) -> np.ndarray:
    """Encoded passages of a whole text, a row each; a text without words is one passage of zeros.

    Passages are encoded ``_SLICE`` at a time. Of the whole text only the bytes, the starts and the numbers of its words and
    their windows are held.
    """
    data = np.frombuffer(raw := text.encode("utf-8", "surrogatepass"), np.uint8)
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    starts = np.flatnonzero(begins)
    del space, begins
    if not len(starts):
        return np.zeros((1, _SIZE), np.float32)
    n = -(-len(starts) // PASSAGE_WORDS)
    seen: dict[bytes, int] = {}
    codes = np.empty(len(starts), np.int32)
    rows = np.empty((n, _SIZE), np.float32)
    for first in range(0, n, _SLICE):
        low, high = first * PASSAGE_WORDS, min((first + _SLICE) * PASSAGE_WORDS, len(starts))
        begin, end = (int(starts[low]) if first else 0), (int(starts[high]) if high < len(starts) else len(raw))
        words = raw[begin:end].split()
        codes[low:high] = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))
        last = codes[low - 1] if low else -1
        rows[first : first + _SLICE] = _encoded(data[begin : end + 1], end - begin, starts[low:high] - begin, codes[low:high], last, len(seen) + 1)
    if len(codes) >= 3:
        owner = np.arange(len(codes) - 2) // PASSAGE_WORDS
        count = np.full(n, PASSAGE_WORDS, np.float64)
        count[-1] = len(codes) - PASSAGE_WORDS * (n - 1)
        rows[:, _MEASURES - 1] = np.bincount(owner[_repeated_windows(codes, len(seen) + 1)], minlength=n) / count
    return rows


def _encoded(data: np.ndarray, size: int, starts: np.ndarray, codes: np.ndarray, last: int, width: int) -> np.ndarray:
    """Encoding of a slice of ``size`` bytes that begins with a passage; ``data`` has the byte after it too, if there is one.

    ``last`` is the code of the word before. The share of repeated windows is left at zero.
    """
    n = -(-len(codes) // PASSAGE_WORDS)
    owner = np.arange(len(codes)) // PASSAGE_WORDS
    count = np.bincount(owner, minlength=n).astype(np.float64)
    firsts = starts[::PASSAGE_WORDS].copy()
    firsts[0] = 0
    char_owner = np.repeat(np.arange(n), np.diff(np.append(firsts, size)))
    table_ = np.bincount(char_owner * 256 + data[:size], minlength=n * 256).reshape(n, 256)
    chars = np.maximum(table_[:, ~_SPACE].sum(1), 1)
    classes = table_ @ _CLASSES.T

    # Words that occurred before in the passage, and words that follow themselves.
    distinct = np.bincount(np.unique(owner * width + codes) // width, minlength=n)
    same_as_last = (codes == np.append(last, codes[:-1])).astype(float)

    following = data[1:].astype(np.uint32)
    pair = ((data[: len(following)].astype(np.uint32) * 2654435761 + following * 40503) >> np.uint32(7)) & (PAIR_BUCKETS - 1)
    pair_table = np.bincount(char_owner[: len(pair)] * PAIR_BUCKETS + pair, minlength=n * PAIR_BUCKETS).reshape(n, PAIR_BUCKETS)
    shares = np.sqrt(pair_table / np.maximum(pair_table.sum(1, keepdims=True), 1)).astype(np.float32)
    measures = np.column_stack([
        np.log1p(count),
        chars / count / 10,
        classes[:, 0] / count,
        classes[:, 1] / count,
        classes[:, 2] / count,
        classes[:, 3] / chars,
        classes[:, 4] / count,
        classes[:, 5] / chars,
        classes[:, 6] / chars,
        distinct / count,
        np.bincount(owner, weights=same_as_last, minlength=n) / count,
        np.zeros(n),
    ])
    return np.hstack([measures.astype(np.float32), shares @ _projection()])


@dataclass(frozen=True)
class QualityModel:
    """Scaling of the encoding, hidden layer, gated attention (V, U, w) and output."""

    mean: np.ndarray
    spread: np.ndarray
    layers: dict[str, np.ndarray]

    def score(self, text: str) -> float:
        rows = np.clip((passages(text) - self.mean) / self.spread, -8, 8)
        _, _, _, _, _, logit = _forward(self.layers, rows, np.zeros(1, np.int64))
        return float(1 / (1 + np.exp(-np.clip(logit[0], -40, 40))))


def _forward(p: dict[str, np.ndarray], rows: np.ndarray, starts: np.ndarray):
    """Hidden layer, gates and attention of passages whose documents begin at ``starts``, and the documents' outputs."""
    h = np.tanh(rows @ p["encode"] + p["encode_bias"])
    t = np.tanh(h @ p["V"])
    s = 1 / (1 + np.exp(-(h @ p["U"])))
    energy = (t * s) @ p["w"]
    sizes = np.diff(np.append(starts, len(rows)))
    energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), sizes))
    a = energy / np.repeat(np.add.reduceat(energy, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return h, t, s, a, z, z @ p["out"] + p["out_bias"][0]


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 0.01, seed: int = 1) -> QualityModel:
    """Learn all layers from bags of encoded passages and a 0/1 label per bag."""
    rng = np.random.default_rng(seed)
    scale = lambda n, m: (rng.normal(size=(n, m)) / np.sqrt(n)).astype(np.float32)
    p = {
        "encode": scale(_SIZE, HIDDEN), "encode_bias": np.zeros(HIDDEN, np.float32), "V": scale(HIDDEN, ATTENTION), "U": scale(HIDDEN, ATTENTION),
        "w": np.zeros(ATTENTION, np.float32), "out": np.zeros(HIDDEN, np.float32), "out_bias": np.zeros(1, np.float32),
    }
    if not bags:
        return QualityModel(np.zeros(_SIZE, np.float32), np.ones(_SIZE, np.float32), p)
    flat = np.concatenate(bags)
    mean, spread = flat.mean(0), flat.std(0) + 1e-3
    scaled = [np.clip((b - mean) / spread, -8, 8) for b in bags]
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            rows = np.concatenate([scaled[k] for k in chosen])
            sizes = np.asarray([len(scaled[k]) for k in chosen])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            h, t, s, a, z, logit = _forward(p, rows, starts)
            slope = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[chosen]) / len(chosen)
            to_z = slope[:, None] * p["out"]
            to_z_rows = np.repeat(to_z, sizes, axis=0)
            to_a = (to_z_rows * h).sum(1)
            to_energy = a * (to_a - np.repeat(np.add.reduceat(a * to_a, starts), sizes))
            gate = to_energy[:, None] * p["w"]
            to_t, to_s = gate * s * (1 - t * t), gate * t * s * (1 - s)
            to_h = (a[:, None] * to_z_rows + to_t @ p["V"].T + to_s @ p["U"].T) * (1 - h * h)
            slopes = {
                "encode": rows.T @ to_h, "encode_bias": to_h.sum(0), "V": h.T @ to_t, "U": h.T @ to_s,
                "w": (t * s).T @ to_energy, "out": z.T @ slope, "out_bias": np.asarray([slope.sum()]),
            }
            step += 1
            for k, g in slopes.items():
                g = g + 1e-5 * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = (p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return QualityModel(mean.astype(np.float32), spread.astype(np.float32), p)


def learn_quality(docs: DataFrame, labels: DataFrame, identifier: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS, seed: int = 9) -> QualityModel:
    """Model from about ``sample_rows`` labels drawn at random (by a hash of the id); passages are encoded by the tasks.

    Drawn are only labels that have a document. A document that is labelled more than once has the mean of its labels; of rows that
    share a labelled id one teaches. The drawn labels are bounded, so they are broadcast to the documents and no text is
    shuffled. Labels that are missing or of unknown documents teach nothing; without any label every score is 0.5.
    """
    ids = docs.select(F.col(identifier).alias("__id")).distinct()
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(identifier).alias("__id")).agg(F.avg(F.col(label).cast("double")).alias("__y"))
    known = known.join(ids, "__id", "left_semi")
    total = known.count()
    if not total:
        return fit([], np.zeros(0))
    share = F.pmod(F.xxhash64("__id", F.lit(seed)), F.lit(_SHARES))
    drawn = known.filter(share < F.lit(int(_SHARES * min(1.0, sample_rows / total))))
    joined = docs.select(F.col(identifier).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(drawn), "__id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [passages(v).astype("<f2").tobytes() for v in texts_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(bags, pa.binary()), batch.column(1)], ["id", "bag", "y"])

    id_kind = docs.schema[identifier].dataType.simpleString()
    encoded = joined.select("__text", "__y", "__id").mapInArrow(encode, f"id {id_kind}, bag binary, y double")
    found = encoded.groupBy("id", "y").agg(F.min("bag").alias("bag")).select("bag", "y").collect()
    # The order of what the tasks return must not matter to the fit.
    found = sorted((bytes(r[0]), r[1]) for r in found)
    bags = [np.frombuffer(b, "<f2").astype(np.float32).reshape(-1, _SIZE) for b, _ in found]
    return fit(bags, np.asarray([y for _, y in found]))


def quality_score(text: Column, model: QualityModel) -> Column:
    """Likelihood of label 1 of a whole text."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([model.score(v) for v in texts_of(column)], pa.float64())

    return F.arrow_udf(run, "double")(text)


def training_labels(labels: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """The labels to learn from: all but the held-out third. A label without an id is left out."""
    return labels.filter(id_fold(F.col(identifier), 3) != 1)


def score_documents(docs: DataFrame, model: QualityModel, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score``, ``predicted``.

    A missing text is scored like an empty one: a single passage of zeros. Repeated rows get equal scores; only
    id and text are read; a row without an id counts as held out; an empty table gives an empty result.
    """
    found = docs.select(F.col(identifier).alias("__id"), quality_score(F.col(text), model).alias("score"))
    held_out = F.coalesce(id_fold(F.col("__id"), 3) == 1, F.lit(True))
    return found.select(F.col("__id").alias(identifier), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return score_documents(docs, learn_quality(docs, training_labels(labels)))


QUERIES: dict[str, tuple[Query, str | None]] = {"op5_quality_classifier": (op5, None)}
