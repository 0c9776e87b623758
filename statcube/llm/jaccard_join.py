"""Near duplicates: an n-gram Jaccard join by MinHash banding with exact verification.

Texts become sets of word shingles. Each of ``TREES`` labels of a set packs ``DEPTH`` small minhash values into one
number, so that a shorter prefix is a right shift. The length of the prefix is fixed in advance, from threshold, number of labels and target
recall alone: the longest at which a pair at the threshold shares the prefix of some label with at least the target recall. By
the defaults these are 40 bands of 5 values; the sixth value is not used. Sets under a common prefix are candidates. This is
no LSH forest: no sorted trie is gone down, and nothing that was matched changes the length.

Links are then verified exactly, without a row per pair. Equal sets are one class. Classes joined by candidate nodes
form candidate components (stars to the least member, min-label propagation with shortcuts). The sets of a component are cut into
blocks of ``BLOCK`` by a hash; a task takes two blocks at a time, counts all intersections as a product of sparse columns and
returns a row per set: how many others it links to, and the least set it is connected with. A component of any size is so spread
over tasks of bounded memory. The connected components of the verified links are the near-duplicate classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statcube.llm.exact_dedup import ROW, merge_runs, number_written
from statcube.llm.shared import Query, sorted_groups, table, texts_of
from statcube.operators.joins import lookup_join
from statcube.sources.scratch import materialize, materialize_counted

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 40
DEPTH = 6
LABEL_BITS = 10
#: Chance that a pair exactly at the threshold is compared; more similar pairs are missed less often.
TARGET_RECALL = 0.999999
BLOCK = 256

_rng = np.random.default_rng(20240501)
_FACTORS = (_rng.integers(0, 2**31, TREES * DEPTH, dtype=np.uint32) * 2 + 1).astype(np.uint32)
_SHIFTS = _rng.integers(0, 2**32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)
_MIX = _rng.integers(0, 2**63, SHINGLE_WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_REMEMBERED = 150_000
_words: dict[str, int] = {}


def stop_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> int:
    """The longest prefix at which a pair at the threshold shares a node of some tree with the target chance."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``n``-word shingles; fewer words are one shingle, no words none."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    try:
        hashes = list(map(_words.__getitem__, words))
    except KeyError:
        if len(_words) > _REMEMBERED:
            _words.clear()
        for w in words:
            if w not in _words:
                _words[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        hashes = list(map(_words.__getitem__, words))
    h = np.asarray(hashes, np.uint64)
    size = min(n, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        # Mixed at each place, so that the order of words counts.
        total = _mixed(total * _MIX[-1] + h[k : len(h) - size + 1 + k] * _MIX[k % len(_MIX)])
    return np.unique(total)


def tree_labels(found: np.ndarray) -> np.ndarray:
    """Labels of a set in all trees: ``DEPTH`` values of ``LABEL_BITS`` bits each, first value on top."""
    least = np.full(TREES * DEPTH, 2**32 - 1, np.uint32)
    low = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    for at in range(0, len(low), 512):
        block = low[at : at + 512, None] * _FACTORS[None, :]
        block += _SHIFTS
        np.minimum(least, block.min(0), out=least)
    values = (least * np.uint32(2654435761)) >> np.uint32(32 - LABEL_BITS)
    labels = np.zeros(TREES, np.int64)
    for column in values.reshape(TREES, DEPTH).T.astype(np.int64):
        labels = (labels << LABEL_BITS) | column
    return labels


def _signatures(docs: DataFrame, identifier: str, text: str) -> DataFrame:
    """``__id``, ``__key`` of the shingle set (NULL without words) and ``__labels`` of every row."""
    id_kind = docs.schema[identifier].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, labels = [], []
            for value in texts_of(batch.column(1)):
                found = shingles(value)
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                labels.append(tree_labels(found) if len(found) else np.zeros(0, np.int64))
            _words.clear()  # the worker lives on with other stages
            ends = np.concatenate([[0], np.cumsum([len(x) for x in labels])]).astype(np.int32)
            flat = np.concatenate(labels) if labels else np.zeros(0, np.int64)
            arrays = [batch.column(0), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(arrays, ["__id", "__key", "__labels"])

    return docs.select(F.col(identifier), F.col(text)).mapInArrow(sign, f"__id {id_kind}, __key binary, __labels array<long>")


def _stars(edges: DataFrame) -> DataFrame:
    """The same components in fewer edges: one from every node to the least head it names, and those between that head and its other heads.

    ``u`` names heads ``v`` below it, a bounded number each. In a dense group most nodes name the same few heads, so that little but the stars is left.
    """
    least = F.array_min("heads")
    others = F.transform(F.array_remove("heads", least), lambda h: F.struct(least.alias("u"), h.alias("v")))
    pairs = F.concat(F.array(F.struct("u", least.alias("v"))), others)
    return edges.groupBy("u").agg(F.collect_set("v").alias("heads")).select(F.inline(pairs)).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of edges (``u``, ``v`` below it): ``node`` and ``root``, the least node of its component.

    Every round takes the least label of the neighbours and then the label's own label, and is written.
    """
    edges = _stars(edges)
    both = materialize(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("root")), "labels")
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("v"), "root"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("root").alias("heard"))
        )
        lower = labels.join(heard, "node").select("node", F.col("root").alias("before"), F.least("root", "heard").alias("root"))
        upper = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        moved = lower.join(upper, "root").select("node", "before", F.least("root", "further").alias("root"))
        written, changes = materialize_counted(moved, "labels", F.col("root") != F.col("before"))
        labels = written.select("node", "root")
        if not changes:
            return labels


def _candidates(classes: DataFrame, depth: int) -> DataFrame:
    """Edges from every class to the least class under the same trie node."""
    unused = LABEL_BITS * (DEPTH - depth)
    entries = classes.filter(F.col("__labels").isNotNull()).select(F.col("keep_id").alias("u"), F.posexplode("__labels").alias("tree", "label"))
    entries = entries.select("u", F.xxhash64("tree", F.shiftright("label", unused)).alias("node"))
    heads = entries.groupBy("node").agg(F.min("u").alias("v"), F.max("u").alias("last")).filter("v < last").drop("last")
    return entries.join(heads, "node").filter("u <> v").select("u", "v").distinct()


def _links(sets: list[np.ndarray], sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, as a square of truth values."""
    n = len(sets)
    inter = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), sizes)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, 4096):
        low, high = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((n, min(4096, width - start)), np.float32)
        part[owner[low:high], column[low:high] - start] = 1
        inter += part @ part.T
    union = sizes[:, None] + sizes[None, :] - inter
    linked = inter / np.maximum(union, 1).astype(np.float64) >= threshold
    np.fill_diagonal(linked, False)
    return linked


def _least_connected(linked: np.ndarray, ids: list) -> list:
    """The least id that each row is connected with."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    reach = linked | np.eye(len(ids), dtype=bool)
    while True:
        lower = np.where(reach, rank[None, :], len(ids)).min(1)
        if (lower == rank).all():
            return [ids[order[k]] for k in rank]
        rank = lower


def _verified(docs: DataFrame, identifier: str, text: str, members: DataFrame, threshold: float, block: int) -> DataFrame:
    """Rows (``node``, ``root``, ``texts``, ``docs``) per block pair: counts of links and the least linked node.

    ``members`` has ``node``, ``component`` and ``group_size``.
    """
    id_kind = docs.schema[identifier].dataType.simpleString()
    pieces = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("pieces"))
    dealt = members.join(pieces, "component").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    # Few documents have candidates: as long as these are measured to be small, no text is shuffled to find them.
    whole = lookup_join(docs.select(F.col(identifier).alias("node"), F.col(text).alias("__text")), dealt, ["node"], "inner")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingles(v).tobytes() for v in texts_of(batch.column(0))], pa.binary())
            _words.clear()
            yield pa.RecordBatch.from_arrays([sets, *batch.columns[1:]], ["set", *batch.schema.names[1:]])

    sets = whole.select("__text", "component", "node", "group_size", "pieces", "piece").mapInArrow(
        encode, f"set binary, component {id_kind}, node {id_kind}, group_size long, pieces int, piece int"
    )
    # A row that is repeated word for word is one set of its node; its copies count by the size of the group.
    sets = sets.dropDuplicates(["component", "node", "set"])
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    units = sets.withColumn("other", other).select(
        "component", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high"), "piece", "node", "group_size", "set"
    )
    units = units.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["component", "low", "high"]):
            if group.num_rows < 2:
                continue
            nodes = group.column("node").to_pylist()
            weight = np.asarray(group.column("group_size"), np.int64)
            piece = np.asarray(group.column("piece"), np.int64)
            found = [np.frombuffer(v.as_py(), np.uint64) for v in group.column("set")]
            linked = _links(found, np.asarray([len(s) for s in found], np.int64), threshold)
            if group.column("low")[0].as_py() != group.column("high")[0].as_py():
                linked &= piece[:, None] != piece[None, :]
            degree = linked.sum(1)
            some = np.flatnonzero(degree)
            if not len(some):
                continue
            roots = _least_connected(linked, nodes)
            kind = group.schema.field("node").type
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([nodes[k] for k in some], kind),
                    pa.array([roots[k] for k in some], kind),
                    pa.array(degree[some]),
                    pa.array((linked.astype(np.int64) @ weight)[some]),
                ],
                ["node", "root", "texts", "docs"],
            )

    return units.mapInArrow(verify, f"node {id_kind}, root {id_kind}, texts long, docs long")


def near_duplicates(docs: DataFrame, identifier: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id``, ``copy_id``, ``n_links``, ``n_text_links``.

    ``class_id`` is the least id of all documents connected by links (similarity of the sets of five-word shingles at least
    the threshold), ``copy_id`` the least id with the same set. ``n_links`` counts the other documents linked to this one, copies
    with the same set included; ``n_text_links`` counts linked sets other than its own. Words are runs without white space, as they
    stand. A text of one to four words is a single shingle. A missing text, or one without words, links to nothing and
    is a class of its own, as is a row without an id. Repeated rows link to each other like copies; rows that share an id are one class. Other columns
    are ignored; an empty table gives an empty result.
    """
    signed = materialize(_signatures(docs, identifier, text), "signatures")
    wordless = F.col("__key").isNull() | F.col("__id").isNull()
    grouped = merge_runs(signed.filter(~wordless), ["__key"], "smallest").withColumn(
        "__labels", F.when(F.col("__id") == F.col("keep_id"), F.col("__labels"))
    )
    classes = materialize(grouped.drop("__key"), "classes")
    edges = _candidates(classes, stop_depth(threshold, target=target_recall))
    components = connected(edges)
    sizes = classes.filter("__labels IS NOT NULL").select(F.col("keep_id").alias("node"), "group_size").distinct()
    members = materialize(components.withColumnRenamed("root", "component").join(sizes, "node"), "members")
    verified = materialize(_verified(docs, identifier, text, members, threshold, block), "links")
    counts = verified.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    found = connected(verified.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    by_text = counts.join(found, "node", "left").withColumnRenamed("node", "keep_id")
    linked = classes.join(by_text, "keep_id", "left").select(
        F.col("__id").alias(identifier),
        F.coalesce("root", "keep_id").alias("class_id"),
        F.col("keep_id").alias("copy_id"),
        (F.coalesce("docs", F.lit(0)) + F.col("group_size") - 1).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
    )
    alone = signed.filter(wordless).select(
        F.col("__id").alias(identifier), F.col("__id").alias("class_id"), F.col("__id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links")
    )
    return linked.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per class, with all its columns: the least id, rows without an id last, then the first row.

    Classes are of rows, numbered once, and not of ids: rows that share an id are one class only if their texts are linked,
    and a row without an id belongs to the class of its text. A row without words stays.
    """
    docs = number_written(docs)
    found = near_duplicates(docs, ROW, text).filter("n_links > 0").select(ROW, "class_id")
    linked = materialize(found.join(docs.select(ROW, F.col(identifier).alias("__id")), ROW), "linked")
    first = F.min(F.struct(F.col("__id").isNull().alias("missing"), "__id", ROW))
    stay = linked.groupBy("class_id").agg(first.alias("first")).select(f"first.{ROW}")
    gone = linked.join(stay, ROW, "left_anti").select(ROW)
    return lookup_join(docs, gone, [ROW], "left_anti").drop(ROW)


def op8(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


QUERIES: dict[str, tuple[Query, str | None]] = {"op8_jaccard_join": (op8, None)}
