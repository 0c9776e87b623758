"""Hard-negative mining by Fagin's threshold algorithm.

Vectors become integers (``floor(scale * x)``), a score is the inner product of two of them. All rows are dealt evenly to blocks by
their number, whatever their id or label, so neither a hot label nor a hot vector gathers anywhere. A cell is a block
of anchors and a block of candidates; a task takes one cell at a time, so its memory is bounded by the two block sizes.

In a cell every dimension has a list of the candidates sorted by that component. An anchor reads each list from its top where its own component is
positive and from its bottom where it is negative (sorted access, deeper in rounds), and scores every candidate that it meets for the
first time by all its components (random access). The threshold is the score of an imagined candidate that has the components last
read in all lists: nothing that was not met scores higher. Access stops once the threshold is strictly
below the kth score of every window, so that ties are all met, or below the least score that a window admits.

First each anchor finds its positives, the best of its own label, in lists of that label alone. A positive's score
opens a window of scores; the second pass finds the best of other labels in each window. Both passes keep ``k`` rows a cell and merge
them by (score, id).

Scores are exact: inner products run in single or double precision where the norms prove that every partial sum is a whole number that
it holds, else in 64-bit or in Python's integers. A score beyond 64 bits ends the job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statcube.llm.shared import Query, one_thread, sorted_groups, table
from statcube.sources.scratch import materialize, materialize_measured

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these hundredths of the positive's, after multiplication with ``WHOLE``.
LOW, HIGH, WHOLE = 30, 90, 100
ANCHOR_EVERY = 100
#: Rows of a block at most, and the fewest that a block is cut down to for the sake of parallel tasks.
CANDIDATE_BLOCK, ANCHOR_BLOCK, LEAST_BLOCK = 65_536, 16_384, 256
LEAST_BLOCKS = 32


def integer_vectors(rows: DataFrame, identifier: str, vector: str, label: Column, anchor: Column, scale: int = SCALE) -> DataFrame:
    """``__id``, ``__label``, ``__anchor`` and ``__vector`` (whole numbers as double) of the rows that take part.

    Rows without an id, label or vector, and those with a missing or non-finite component, take no part.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = F.col(identifier).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & ~bad
    # floor() of a double is a long in Spark; what no long holds is whole already.
    scaled = lambda x: x.cast("double") * scale
    whole = lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
    return rows.filter(known).select(
        F.col(identifier).cast("long").alias("__id"),
        label.cast("long").alias("__label"),
        F.coalesce(anchor, F.lit(False)).alias("__anchor"),
        F.transform(vector, lambda x: whole(scaled(x))).alias("__vector"),
    )


def block_count(rows: int, most: int, blocks: int | None) -> int:
    """Blocks of at most ``most`` rows; more of them if there are few, so that the tasks have something to share."""
    if blocks is not None:
        return max(1, blocks)
    return max(1, -(-rows // most), min(LEAST_BLOCKS, rows // LEAST_BLOCK))


def _exact(vectors: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the cheapest type in which no partial sum of any inner product is rounded."""
    bound = math.sqrt(float((vectors**2).sum(1).max(initial=0))) * math.sqrt(float((anchors**2).sum(1).max(initial=0)))
    bound *= math.sqrt(max(1, vectors.shape[1]))  # the threshold mixes components of many vectors
    if bound < 2.0**24:
        return vectors.astype(np.float32), anchors.astype(np.float32)
    if bound < 2.0**53:
        return vectors, anchors
    if bound < 2.0**62 and max(np.abs(vectors).max(), np.abs(anchors).max()) < 2.0**62:
        return vectors.astype(np.int64), anchors.astype(np.int64)
    as_whole = np.frompyfunc(int, 1, 1)
    return as_whole(vectors), as_whole(anchors)


class SortedLists:
    """Candidates sorted by every component."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        self.vectors, self.ids = vectors, ids
        self.order = np.argsort(vectors, axis=0, kind="stable") if vectors.size else np.zeros(vectors.shape, np.int64)

    def best(self, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, usable: np.ndarray, first: int = 8) -> tuple[list[np.ndarray], np.ndarray, int]:
        """Places of the ``k`` best usable candidates of every window (low, high), all scores, and how many were met."""
        n = len(self.ids)
        scores = np.zeros(n, anchor.dtype)
        met = np.zeros(n, bool)
        down = np.flatnonzero(anchor > 0)
        up = np.flatnonzero(anchor < 0)
        depth, step, total = 0, first, 0
        kept = [np.zeros(0, np.int64) for _ in windows]
        open_windows = set(range(len(windows)))
        if not len(down) and not len(up):  # every score is 0
            depth = n
            found = np.flatnonzero(usable)
            kept = [self._least(found if low <= 0 <= high else found[:0], scores, k) for low, high in windows]
            return kept, scores, n
        while open_windows and depth < n:
            end = min(n, depth + step)
            seen = np.concatenate([self.order[n - end : n - depth, down].ravel(), self.order[depth:end, up].ravel()])
            fresh = np.zeros(n, bool)
            fresh[seen] = True
            fresh &= ~met
            new = np.flatnonzero(fresh)
            met |= fresh
            total += len(new)
            scores[new] = self.vectors[new] @ anchor
            threshold = self.vectors[self.order[n - end, down], down] @ anchor[down] + self.vectors[self.order[end - 1, up], up] @ anchor[up]
            new = new[usable[new]]
            for w in list(open_windows):
                low, high = windows[w]
                inside = new[(scores[new] >= low) & (scores[new] <= high)]
                if len(inside):
                    kept[w] = self._least(np.concatenate([kept[w], inside]), scores, k)
                full = len(kept[w]) == k and threshold < scores[kept[w][-1]]
                if full or threshold < low:
                    open_windows.discard(w)
            depth, step = end, step * 2
        return kept, scores, total

    def _least(self, places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        if scores.dtype == object:
            order = sorted(range(len(places)), key=lambda i: (-scores[places[i]], self.ids[places[i]]))
            return places[order[:k]]
        if len(places) > 4 * k:
            # Only what reaches the kth score can be among the first k.
            edge = np.partition(scores[places], len(places) - k)[len(places) - k]
            places = places[scores[places] >= edge]
        return places[np.lexsort((self.ids[places], -scores[places]))[:k]]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of unequal length are filled with zeros."""
    lists = column.combine_chunks()
    lengths = np.diff(np.asarray(lists.offsets))
    width = int(lengths.max(initial=0))
    values = np.asarray(lists.flatten(), np.float64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _block(number: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(blocks)).cast("int")


def _cells(anchors: DataFrame, candidates: DataFrame, anchor_blocks: int, blocks: int) -> DataFrame:
    """Anchors and candidates of every cell next to each other, in the partition of the cell.

    ``anchors`` has ``__number``, ``__windows`` and the vector, ``candidates`` the vector; a block goes to every cell it is part of.
    """
    a = anchors.select(
        _block("__number", anchor_blocks).alias("a_block"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c_block"),
        F.lit(True).alias("is_anchor"), "__number", "__id", "__label", "__windows", "__vector",
    )
    c = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("a_block"),
        _block("__number", blocks).alias("c_block"),
        F.lit(False).alias("is_anchor"), "__number", "__id", "__label",
        F.lit(None).cast("array<struct<rank:int,id:bigint,score:bigint>>").alias("__windows"), "__vector",
    )
    return a.unionByName(c).repartition("a_block", "c_block").sortWithinPartitions("a_block", "c_block")


_FOUND = "anchor long, anchor_id long, positive int, positive_id long, positive_score long, found_id long, found_score long"


def _search(cells: DataFrame, same_label: bool, k: int, low: int, high: int, whole: int) -> DataFrame:
    """The ``k`` best of every anchor (or of every window of an anchor) in each cell."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        for group in sorted_groups(batches, ["a_block", "c_block"]):
            is_anchor = np.asarray(group.column("is_anchor"))
            if is_anchor.all() or not is_anchor.any():
                continue
            numbers, ids, labels = (np.asarray(group.column(c)) for c in ("__number", "__id", "__label"))
            vectors = _matrix(group.column("__vector"))
            at = np.flatnonzero(is_anchor)
            of = np.flatnonzero(~is_anchor)
            whole_windows = group.column("__windows").take(pa.array(at)).to_pylist()
            values, sought = _exact(vectors[of], vectors[at])
            ids_of, labels_of, numbers_of = ids[of], labels[of], numbers[of]
            lists = {}
            rows: list[tuple] = []
            everything = None if same_label else SortedLists(values, ids_of)
            for row, place, positives in zip(sought, at, whole_windows):
                label = labels[place]
                if same_label:
                    if label not in lists:
                        own = np.flatnonzero(labels_of == label)
                        lists[label] = (own, SortedLists(values[own], ids_of[own]))
                    own, source = lists[label]
                    windows, usable = [(-math.inf, math.inf)], numbers_of[own] != numbers[place]
                    marks: list = [(None, None, None)]
                else:
                    source, usable = everything, labels_of != label
                    # low * p <= whole * s <= high * p in whole numbers
                    marks = [(p["rank"], p["id"], p["score"]) for p in positives]
                    windows = [(-(-low * s // whole), high * s // whole) for _, _, s in marks]
                    alive = [i for i, (least, most) in enumerate(windows) if least <= most]
                    marks, windows = [marks[i] for i in alive], [windows[i] for i in alive]
                if not windows or not len(source.ids):
                    continue
                best, scores, _ = source.best(row, windows, k, usable)
                for mark, places in zip(marks, best):
                    rows += [(int(numbers[place]), int(ids[place]), *mark, int(source.ids[i]), int(scores[i])) for i in places]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], [x.split()[0] for x in _FOUND.split(", ")])

    return cells.mapInArrow(search, _FOUND)


def mine_hard_negatives(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    whole: int = WHOLE,
    anchor_blocks: int | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` of every anchor row and positive.

    ``vectors`` is the result of ``integer_vectors``. Positives are the first ``positives`` other rows of the anchor's label, negatives the first
    ``negatives`` rows of other labels with ``low * positive_score <= whole * negative_score <= high * positive_score``;
    higher scores come first, ties by smaller id, all if there are fewer. Rows count one by one: a
    repeated anchor row gives its result again and is a positive of its twin. Vectors of unequal length are filled with zeros. A positive without negatives
    has no rows; an empty table, or one without anchors, gives an empty result.
    """
    # Written, so that the numbers don't change between the passes.
    rows, size = materialize_measured(vectors.withColumn("__number", F.monotonically_increasing_id()), "vectors")
    anchors, chosen = materialize_measured(rows.filter("__anchor"), "anchors")
    blocks = block_count(size.rows, CANDIDATE_BLOCK, blocks)
    anchor_blocks = anchor_blocks or max(1, -(-chosen.rows // ANCHOR_BLOCK))

    opening = anchors.withColumn("__windows", F.lit(None).cast("array<struct<rank:int,id:bigint,score:bigint>>"))
    near = _search(_cells(opening, rows, anchor_blocks, blocks), True, positives, low, high, whole)
    best_first = Window.partitionBy("anchor").orderBy(F.desc("found_score"), F.asc("found_id"))
    first = near.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= positives)
    windows = first.groupBy("anchor").agg(
        F.collect_list(F.struct("rank", F.col("found_id").alias("id"), F.col("found_score").alias("score"))).alias("__windows")
    )
    windows = materialize(windows, "positives")
    with_windows = anchors.join(windows.withColumnRenamed("anchor", "__number"), "__number")
    far = _search(_cells(with_windows, rows, anchor_blocks, blocks), False, negatives, low, high, whole)
    best_first = Window.partitionBy("anchor", "positive").orderBy(F.desc("found_score"), F.asc("found_id"))
    ranked = far.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("found_score").alias("negative_score"),
    )


def op13(spark, folder):
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(integer_vectors(rows, "vec_id", "embedding", label, F.col("vec_id") % ANCHOR_EVERY == 0))


OP13_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS number, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.number AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.number <> b.number
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same
  QUALIFY place <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON n.anchor = p.anchor AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

QUERIES: dict[str, tuple[Query, str | None]] = {"op13_hard_negatives": (op13, OP13_SQL)}
