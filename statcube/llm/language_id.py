"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1; for few languages all distinct splits of the languages into two sides are used. Each bit
is a logistic regression on hashed character n-grams (one to three letters) of whole texts. Decoding is loss-weighted: a
language's distance is the weighted sum of the losses of its bits, where a bit weighs as much as it was right on the language's training
texts. The nearest codeword is the prediction; texts whose two nearest codewords are about as near are flagged.
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

UNKNOWN = "und"
#: Labelled texts from which the classifiers are fitted, about (a random sample in equal parts from all languages).
SAMPLE_ROWS = 2500
#: Labelled texts of a language that are drawn at least, about, however many languages there are.
LEAST_ROWS = 10
BUCKETS = 4096
#: Below this confidence a prediction is flagged as ambiguous.
CLEAR_SCORE = 0.5
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    flags = np.zeros(0x110000, bool)
    flags[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return flags


def features(text: str) -> np.ndarray | None:
    """Square roots of the shares of hashed n-grams of a text; None if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = _letters()[points] if len(points) else np.zeros(0, bool)
    if not known.any():
        return None
    # A run of other characters counts as one blank; the text stands between blanks.
    held = known | np.concatenate([[True], known[:-1]])
    points = np.where(known, points, 32)[held].astype(np.uint64)
    points = np.concatenate([[np.uint64(32)], points, [np.uint64(32)]])
    counts = np.zeros(BUCKETS)
    gram = np.zeros_like(points)
    for size, multiplier in enumerate(_MULTIPLIERS):
        gram = (gram[: len(points) - size] if size == 0 else gram[:-1]) * np.uint64(0x100000001B3) + points[size:]
        codes = (gram * np.uint64(multiplier)) >> np.uint64(52)
        counts += np.bincount(codes.astype(np.int64), minlength=BUCKETS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """A row of +1 and -1 per language: all splits up to 6 languages, beyond that random ones that differ widely."""
    if n < 2:
        return np.zeros((n, 0), np.float32)
    if n <= 6:
        splits = [[1 if k == 0 or (s >> (k - 1)) & 1 else -1 for k in range(n)] for s in range(2 ** (n - 1) - 1)]
        return np.asarray(splits, np.float32).T
    rng = np.random.default_rng(seed)
    bits, best, widest = 4 * int(np.ceil(np.log2(n))) + 8, None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits)).astype(np.float32)
        if (abs(code.sum(0)) == n).any():
            continue
        apart = (bits - code @ code.T) / 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > widest:
            best, widest = code, least
    return best


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords, the bits' classifiers, and each bit's weight for each language."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, confidence from 0 to 1, and whether the choice is ambiguous."""
        found = features(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = found @ self.weights + self.bias
        distance = (self.trust * np.logaddexp(0, -self.code * margins)).sum(1) * self.code.shape[1]
        likely = np.exp(distance.min() - distance)
        likely /= likely.sum()
        best = int(distance.argmin())
        return self.languages[best], float(likely[best]), bool(likely[best] < CLEAR_SCORE)


def fit(rows: np.ndarray, labels: list[str], rounds: int = 120, rate: float = 8.0, decay: float = 1e-5) -> LanguageModel:
    """Fit the bits by gradient descent with momentum; languages weigh alike, however many rows they have."""
    languages = tuple(sorted(set(labels)))
    code = codewords(len(languages))
    if len(languages) < 2:
        empty = np.zeros(0, np.float32)
        return LanguageModel(languages, code, np.zeros((BUCKETS, 0), np.float32), empty, np.zeros_like(code))
    place = np.asarray([languages.index(x) for x in labels])
    share = 1.0 / (np.bincount(place)[place] * len(languages))
    target = code[place]
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    speed, bias_speed = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(rounds):
        slope = -target / (1 + np.exp(np.clip(target * (rows @ weights + bias), -30, 30))) * share[:, None]
        slope = slope.astype(np.float32)
        speed = 0.9 * speed - rate * (rows.T @ slope + decay * weights)
        bias_speed = 0.9 * bias_speed - rate * slope.sum(0) / 10
        weights, bias = weights + speed, bias + bias_speed
    right = (target * (rows @ weights + bias) > 0).astype(np.float64)
    trust = np.stack([right[place == k].mean(0) for k in range(len(languages))]) + 1e-3
    return LanguageModel(languages, code, weights, bias, (trust / trust.sum(1, keepdims=True)))


def learn_languages(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> LanguageModel:
    """Model from a random sample of about ``sample_rows`` labelled texts; n-gram shares are made by the tasks.

    Languages are counted over all labelled rows and each gets an equal part of the sample, all its rows if it has fewer, so every
    language with a text to learn from is known to the model. Rows without a language and texts without letters teach nothing.
    """
    labelled = labelled.filter(F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"))
    counts = {r[0]: r[1] for r in labelled.groupBy("l").count().collect()}
    if not counts:
        return fit(np.zeros((0, BUCKETS), np.float32), [])
    quota = max(LEAST_ROWS, sample_rows / len(counts))
    shares = {name: min(1.0, quota / n) for name, n in counts.items()}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, places, values = [], [], []
            for value, name in zip(texts_of(batch.column(0)), batch.column(1)):
                found = features(value)
                if found is not None:
                    at = np.flatnonzero(found)
                    names.append(name.as_py())
                    places.append(at.astype("<u2").tobytes())
                    values.append(found[at].astype("<f2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.binary()), pa.array(values, pa.binary())], ["l", "p", "v"])

    schema = "l string, p binary, v binary"
    found = labelled.sampleBy("l", shares, seed).mapInArrow(encode, schema).collect()
    # A language of which nothing was drawn that has a letter is looked through as a whole.
    for name in sorted(counts.keys() - {r[0] for r in found}):
        if shares[name] < 1:
            found += labelled.filter(F.col("l") == name).mapInArrow(encode, schema).limit(int(quota)).collect()
    # The order of what the tasks return must not matter to the fit.
    found = sorted((r[0], bytes(r[1]), bytes(r[2])) for r in found)
    rows = np.zeros((len(found), BUCKETS), np.float32)
    for k, (_, at, values) in enumerate(found):
        rows[k, np.frombuffer(at, "<u2")] = np.frombuffer(values, "<f2")
    return fit(rows, [r[0] for r in found])


def identify(text: Column, model: LanguageModel) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``ambiguous`` of a whole text."""

    def run(column: pa.Array) -> pa.Array:
        found = [model.predict(value) for value in texts_of(column)]
        names, scores, flags = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())], ["lang_pred", "score", "ambiguous"])

    return F.arrow_udf(run, "struct<lang_pred:string,score:double,ambiguous:boolean>")(text)


def has_letters(text: Column) -> Column:
    """Whether a text has a letter; a missing one has none."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([any(map(str.isalpha, value.lower())) for value in texts_of(column)], pa.bool_())

    return F.arrow_udf(run, "boolean")(text)


def training_rows(docs: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """The rows to learn from: all but the held-out quarter. A row without an id is held out."""
    return docs.filter(F.coalesce(id_fold(F.col(identifier), 4) != 2, F.lit(False)))


def predict_languages(docs: DataFrame, model: LanguageModel, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``, ``ambiguous``.

    A missing text, or one without letters, is ``und`` with score 0; so is every text if nothing could be learned. Repeated
    rows get equal results; only id and text are read; an empty table gives an empty result.
    """
    found = docs.select(F.col(identifier).alias("__id"), identify(F.col(text), model).alias("__p"))
    held_out = F.coalesce(id_fold(F.col("__id"), 4) == 2, F.lit(True))
    return found.select(F.col("__id").alias(identifier), held_out.alias("held_out"), "__p.lang_pred", "__p.score", "__p.ambiguous")


def op4(spark, folder):
    docs = table(spark, folder, "documents")
    return predict_languages(docs, learn_languages(training_rows(docs)))


QUERIES: dict[str, tuple[Query, str | None]] = {"op4_language_id": (op4, None)}
