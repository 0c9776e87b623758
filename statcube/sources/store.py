"""Partitioned Parquet store of cubes with an append-only log.

``<root>/data`` holds datasets: a folder per layout of a cube, with one or several parts (``cube_part=...``). The first write, every append,
every step of an import and every refresh write a part of their own. ``<root>/_registry`` is the log: every commit is one small file
with a row per part that it adds or removes and a row per piece (the folder of one combination of partition values). The current state
is what was added and not removed, found by aggregation; nothing is read, changed and written back.

* Appends only add rows, so any number of them can run at once and none is lost. Their cost does not depend on how many went before.
* Commits that remove parts (store again, repartition, refresh) raise a flag first and look for others then: two at once can't both go
  on, at least one sees the other and raises ``StoreConflict``. They remove the parts that they have read; rows appended meanwhile stay.
* Removed parts stay readable by the frames and versions that use them until ``release_versions`` deletes their files.

A commit is one file, so a failed write leaves the state as it was.
"""

from __future__ import annotations

import json
import re
import uuid
import warnings
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statcube.functions import expressions as X
from statcube.functions.names import (
    CUBE_ID,
    GEO_UID,
    any_match,
    column,
    language_code,
    names_for,
    reject_duplicate_columns,
    same_columns,
)
from statcube.operators.joins import lookup_join
from statcube.sources.scratch import materialize

FORMAT = "parquet"
PART = "cube_part"
#: Suffix of the id under which the records that did not fit a cube's header are stored; both share one log.
QUARANTINE = "~quarantine"
# Header shape of value columns in semi-wide extracts.
WIDE_VALUE = r" \(\d+[A-Z]*\):.+\[\d+\]$"
#: A row of the log. ``stored`` opens a layout and ``appended`` adds a part; ``piece`` names a folder of one of these; ``removed`` ends a piece, or a
#: whole part if it names no piece; ``released`` tells that the files of a removed part or piece are deleted.
LOG_SCHEMA = (
    f"{CUBE_ID} string, language string, commit string, action string, part string, piece string, piece_uri string, "
    "format string, title string, partitioning array<string>, schema_json string, time_cached timestamp, bytes bigint"
)
_ENTRY = ("format", "title", "partitioning", "schema_json")
# A flag that a writer left behind does not count any more after this time.
FLAG_LIFE = timedelta(hours=24)


class StoreConflict(RuntimeError):
    """Two commits at once that replace parts of one cube; repeat the one that raised this."""


def _registry_path(root: str) -> str:
    return f"{root.rstrip('/')}/_registry"


def _cube_log(root: str, cube_id: str, language: str) -> str:
    return f"{_registry_path(root)}/cubes/{quote(cube_id.removesuffix(QUARANTINE), safe='')}-{language}"


def _new_dataset(root: str, cube_id: str, language: str) -> str:
    return f"{root.rstrip('/')}/data/{cube_id}-{language}-{uuid.uuid4().hex}"


def _new_part(dataset: str) -> str:
    return f"{dataset}/{PART}={uuid.uuid4().hex}"


def dataset_folder(part: str) -> str:
    """The folder that holds the parts of one layout."""
    return part.rpartition("/")[0]


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def _remove_folder(spark: SparkSession, root: str, folder: str) -> None:
    """Delete a part or piece of this store, and nothing outside its data folder; a dataset without parts goes too."""
    inside = f"{root.rstrip('/')}/data/"
    # The plain path and the one that Spark reports differ in how they name the file system.
    plain = re.sub(r"^[a-z0-9]+:/*(?=/)", "", folder)
    if not plain.startswith(re.sub(r"^[a-z0-9]+:/*(?=/)", "", inside)) or f"/{PART}=" not in plain or "/../" in plain:
        raise ValueError(f"{folder} lies outside the store")
    system, target = _file_system(spark, folder)
    system.delete(target, True)
    dataset, above = _file_system(spark, folder[: folder.index(f"/{PART}=")])
    if dataset.exists(above) and not list(dataset.listStatus(above)):
        dataset.delete(above, True)


def _rows(spark: SparkSession, values: Iterable[dict]) -> DataFrame:
    """Log rows of a commit, made on the driver; what is not given is NULL."""
    schema = T.StructType.fromDDL(LOG_SCHEMA)
    structs = [F.struct(*[F.lit(v.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]) for v in values]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def _folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def _pieces(spark: SparkSession, part: str) -> DataFrame:
    """Folders of a written part with their bytes, from a listing; no file is opened. Only the new part is measured."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(part)
        .select(_folder_of(F.col("path")).alias("piece"), _folder_of(F.col("_metadata.file_path")).alias("piece_uri"), "length")
    )
    # Paths and lengths only; one task writes them into the one file of the commit anyway.
    return files.coalesce(1).groupBy("piece", "piece_uri").agg(F.sum("length").cast("bigint").alias("bytes"))


def _commit(spark: SparkSession, place: str, rows: DataFrame, commit: str) -> None:
    """Write the rows of a commit as one file in a folder of its own, so that commits at the same time don't meet."""
    rows.coalesce(1).write.parquet(f"{place}/{commit}")


def _added(spark: SparkSession, part: str, action: str, **common) -> DataFrame:
    """Rows that add a part: one with its description, one for each piece."""
    described = _rows(spark, [{"action": action, "part": part, "format": FORMAT, **common}])
    known = {f.name: F.lit(common.get(f.name)).cast(f.dataType) for f in T.StructType.fromDDL(LOG_SCHEMA).fields if f.name not in _ENTRY}
    given = {**known, "action": F.lit("piece"), "part": F.lit(part), "piece": F.col("piece"), "piece_uri": F.col("piece_uri"), "bytes": F.col("bytes")}
    pieces = _pieces(spark, part).select(*[c.alias(name) for name, c in given.items()])
    return described.unionByName(pieces, allowMissingColumns=True)


def _log(spark: SparkSession, *folders: str) -> DataFrame:
    present = [f for f in folders if _exists(spark, f)]
    if not present:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(*present)


def _log_of(spark: SparkSession, root: str, cube_id: str, language: str, appends: bool = True) -> DataFrame:
    """Log of one cube, its drops included; without the appends its size does not depend on their number."""
    own = _cube_log(root, cube_id, language)
    kinds = ("replaced", "appended") if appends else ("replaced",)
    log = _log(spark, *[f"{own}/{k}" for k in kinds], f"{_registry_path(root)}/dropped")
    # The log of one cube is small; in one partition its aggregation needs no shuffle.
    return log.coalesce(1).filter((F.col(CUBE_ID) == cube_id) & (F.col("language") == language))


def _parts(log: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Parts that were added and not removed: description, bytes, and the pieces that are left if some were removed."""
    if as_of is not None:
        log = log.filter(F.col("time_cached") <= F.lit(as_of))
    is_part = F.col("action").isin("stored", "appended")
    key = [CUBE_ID, "language", "part"]
    pieces = log.groupBy(*key, "piece").agg(
        F.max(F.col("action") == "removed").alias("gone"),
        F.max("bytes").alias("bytes"),
        F.max(F.when(is_part, F.struct("time_cached", (F.col("action") == "stored").alias("opens"), *_ENTRY))).alias("entry"),
    )
    left = F.col("piece").isNotNull() & ~F.col("gone")
    parts = pieces.groupBy(*key).agg(
        F.max("entry").alias("entry"),
        F.max(F.col("piece").isNull() & F.col("gone")).alias("gone"),
        F.sum(F.when(left, F.col("bytes")).otherwise(0)).alias("bytes"),
        F.max(F.col("piece").isNotNull() & F.col("gone")).alias("partial"),
        F.collect_list(F.when(left, F.col("piece"))).alias("pieces"),
    )
    current = parts.filter(~F.col("gone") & F.col("entry").isNotNull())
    return current.withColumn("pieces", F.when(F.col("partial"), F.col("pieces"))).drop("gone", "partial")


def registry_entries(spark: SparkSession, root: str) -> DataFrame:
    """Current entry of every stored (cube, language): description, time of the last commit, bytes and parts."""
    parts = _parts(_log(spark, _registry_path(root)))
    return parts.groupBy(CUBE_ID, "language").agg(
        F.max_by("entry", F.struct("entry.opens", "entry.time_cached")).alias("entry"),
        F.max("entry.time_cached").alias("time_cached"),
        F.sum("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("n_parts"),
    ).select(CUBE_ID, "language", *[f"entry.{c}" for c in _ENTRY], "time_cached", "bytes", "n_parts")


def cube_versions(spark: SparkSession, root: str, cube_id: str, language: str = "eng") -> DataFrame:
    """Commits of a cube: ``commit``, ``time_cached`` and how many parts and pieces each added and removed.

    A version can be opened ``as_of`` its time until its parts are released.
    """
    action, whole = F.col("action"), F.col("piece").isNull()
    return _log_of(spark, root, cube_id, language_code(language)).groupBy("commit", "time_cached").agg(
        F.count_if(action.isin("stored", "appended")).alias("parts_added"),
        F.count_if(action == "piece").alias("pieces_added"),
        F.count_if((action == "removed") & whole).alias("parts_removed"),
        F.count_if((action == "removed") & ~whole).alias("pieces_removed"),
        F.sum(F.when(action == "piece", F.col("bytes")).otherwise(0)).alias("bytes_added"),
    )


def listed_parts(spark: SparkSession, root: str, cube_id: str, language: str = "eng") -> set[str]:
    """Folders of all parts that were ever added to a cube, removed ones too."""
    log = _log_of(spark, root, cube_id, language_code(language))
    return {r.part for r in log.filter(F.col("action").isin("stored", "appended")).select("part").distinct().collect()}


def _state(spark: SparkSession, root: str, cube_id: str, language: str, as_of: datetime | None = None) -> list:
    """The parts of one cube, one row each, those that open a layout last."""
    found = _parts(_log_of(spark, root, cube_id, language), as_of).collect()
    if not found:
        raise ValueError(f"Cube {cube_id} ({language}) is not in the store")
    return sorted(found, key=lambda r: (r.entry.opens, r.entry.time_cached))


@contextmanager
def _replacing(spark: SparkSession, root: str, cube_id: str, language: str) -> Iterator[str]:
    """The id of a commit that removes parts, while no other such commit on the cube is under way.

    Every such writer raises its flag before it looks for those of others, so of two at least one sees the other and gives up.
    """
    commit = uuid.uuid4().hex
    place = f"{_cube_log(root, cube_id, language)}/_flags"
    system, flag = _file_system(spark, f"{place}/{commit}")
    system.create(flag).close()
    try:
        oldest = (datetime.now(timezone.utc) - FLAG_LIFE).timestamp() * 1000
        others = [f for f in system.listStatus(flag.getParent()) if f.getPath().getName() != commit and f.getModificationTime() > oldest]
        if others:
            raise StoreConflict(f"Another commit replaces parts of cube {cube_id} ({language})")
        yield commit
    finally:
        system.delete(flag, False)


def _removal(cube_id: str, language: str, commit: str, now: datetime, part: str, piece: str | None = None) -> dict:
    return {CUBE_ID: cube_id, "language": language, "commit": commit, "time_cached": now, "action": "removed", "part": part, "piece": piece}


def add_geo_uid(df: DataFrame) -> DataFrame:
    """Add ``GeoUID`` from ``DGUID`` if the cube has one."""
    if "DGUID" not in df.columns or GEO_UID in df.columns:
        return df
    return df.withColumn(GEO_UID, X.geo_uid_from_dguid(F.col("DGUID")))


def typed_for_store(df: DataFrame, language: str = "eng") -> DataFrame:
    """Value columns as double, ``GeoUID`` derived, everything else as it is."""
    reject_duplicate_columns(df.columns)
    kinds = dict(df.dtypes)
    values = [names_for(language).value, *any_match(df.columns, WIDE_VALUE)]
    numeric = {
        c: X.to_number(column(c)) for c in values if c in kinds and kinds[c] != "double"
    }
    return add_geo_uid(df.withColumns(numeric))


def _laid_out(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Order rows for writing: few files per partition, hot partitions cut into several files."""
    keys = [column(c) for c in partition_by]
    inner = [column(c) for c in cluster_by]
    if keys:
        # The adaptive rebalance splits a partition value that holds much of the data.
        return df.hint("rebalance", *keys).sortWithinPartitions(*keys, *inner)
    if inner:
        return df.repartitionByRange(*inner).sortWithinPartitions(*inner)
    return df


def _replace(
    spark: SparkSession, root: str, cube_id: str, language: str, commit: str, part: str, removed: Iterable[tuple[str, str | None]],
    partitioning: Sequence[str], schema_json: str, title: str | None, beside: dict | None = None,
) -> None:
    """Commit a part in place of (part, piece) pairs, whole parts where the piece is None; ``beside`` describes a quarantined part."""
    now = datetime.now(timezone.utc)
    rows = _added(
        spark, part, "stored", cube_id=cube_id, language=language, commit=commit, time_cached=now, title=title, partitioning=list(partitioning), schema_json=schema_json
    )
    if beside is not None:
        rows = rows.unionByName(_added(spark, **beside, action="stored", cube_id=cube_id + QUARANTINE, language=language, commit=commit, time_cached=now))
    gone = [_removal(cube_id, language, commit, now, p, piece) for p, piece in removed]
    if beside is not None:
        held = [p for p in _part_names(spark, root, cube_id + QUARANTINE, language) if p != beside["part"]]
        gone += [_removal(cube_id + QUARANTINE, language, commit, now, p) for p in held]
    _commit(spark, f"{_cube_log(root, cube_id, language)}/replaced", rows.unionByName(_rows(spark, gone)) if gone else rows, commit)


def store_cube(
    df: DataFrame,
    root: str,
    cube_id: str,
    language: str = "eng",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    title: str | None = None,
    typed: bool = True,
) -> DataFrame:
    """Write a cube and register it in place of what was stored; returns the stored cube.

    ``cluster_by`` sorts rows inside the files, so that Parquet statistics prune reads of
    single series. Parts that are appended while the cube is written stay.
    """
    spark, lang = df.sparkSession, language_code(language)
    ready = typed_for_store(df, lang) if typed else df
    absent = [c for c in [*partition_by, *cluster_by] if c not in ready.columns]
    if absent:
        raise ValueError(f"The cube lacks columns to partition or sort by: {absent}")
    with _replacing(spark, root, cube_id, lang) as commit:
        before = _part_names(spark, root, cube_id, lang)
        part = _new_part(_new_dataset(root, cube_id, lang))
        _laid_out(ready, partition_by, cluster_by).write.partitionBy(*partition_by).parquet(part)
        _replace(spark, root, cube_id, lang, commit, part, [(p, None) for p in before], partition_by, ready.schema.json(), title)
    return _frame(spark, ready.schema, {dataset_folder(part): [part]})


def _part_names(spark: SparkSession, root: str, cube_id: str, language: str) -> list[str]:
    own = _cube_log(root, cube_id, language)
    if not any(_exists(spark, f"{own}/{kind}") for kind in ("replaced", "appended")):
        return []
    return [r.part for r in _parts(_log_of(spark, root, cube_id, language)).select("part").collect()]


def _opening(spark: SparkSession, root: str, cube_id: str, language: str):
    """Description and a part of the layout that appends go to; found without reading the log of appends."""
    latest = _parts(_log_of(spark, root, cube_id, language, appends=False)).filter("entry.opens")
    row = latest.orderBy(F.desc("entry.time_cached")).first()
    return row if row is not None else _state(spark, root, cube_id, language)[-1]


def _append_part(spark: SparkSession, root: str, cube_id: str, language: str, part: str, entry, beside: dict | None = None) -> None:
    commit, now = uuid.uuid4().hex, datetime.now(timezone.utc)
    rows = _added(
        spark, part, "appended", cube_id=cube_id, language=language, commit=commit, time_cached=now,
        title=entry["title"], partitioning=list(entry["partitioning"]), schema_json=entry["schema_json"],
    )
    if beside is not None:
        rows = rows.unionByName(_added(spark, **beside, action="appended", cube_id=cube_id + QUARANTINE, language=language, commit=commit, time_cached=now))
    _commit(spark, f"{_cube_log(root, cube_id, language)}/appended", rows, commit)


def register_part(
    spark: SparkSession,
    root: str,
    cube_id: str,
    language: str,
    folder: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    title: str | None = None,
    quarantined: str | None = None,
    quarantine_schema: T.StructType | None = None,
) -> None:
    """Register a written part of a cube, and the records that were set apart beside it: both by one commit, or neither.

    It is added to the stored cube if that lies in the same dataset folder, else it replaces it.
    A part that is listed already counts once, and one that was removed does not come back.
    """
    beside = None
    if quarantined is not None:
        beside = {"part": quarantined, "title": title, "partitioning": [], "schema_json": quarantine_schema.json()}
    lang = language_code(language)
    entry = {"title": title, "partitioning": list(partition_by), "schema_json": schema.json()}
    layouts = _log_of(spark, root, cube_id, lang, appends=False).filter("action = 'stored'").select("part", "time_cached")
    latest = layouts.orderBy(F.desc("time_cached")).first()
    if latest is not None and dataset_folder(latest.part) == dataset_folder(folder):
        _append_part(spark, root, cube_id, lang, folder, entry, beside)
        return
    with _replacing(spark, root, cube_id, lang) as commit:
        before = [(p, None) for p in _part_names(spark, root, cube_id, lang) if p != folder]
        _replace(spark, root, cube_id, lang, commit, folder, before, partition_by, schema.json(), title, beside)


def open_quarantine(spark: SparkSession, root: str, cube_id: str, language: str = "eng", as_of: datetime | None = None) -> DataFrame:
    """Records that an import with ``quarantine`` set apart: their text and the file each came from."""
    return open_cube(spark, root, cube_id + QUARANTINE, language, as_of)


def append_to_cube(df: DataFrame, root: str, cube_id: str, language: str = "eng") -> DataFrame:
    """Add rows to a stored cube, in its schema and partitioning.

    They are written to a part of their own that counts once it is registered: an append that fails leaves
    nothing behind that can be read, and can be repeated. Appends may run at the same time, from any number of drivers.
    """
    spark, lang = df.sparkSession, language_code(language)
    opening = _opening(spark, root, cube_id, lang)
    entry = opening.entry.asDict()
    schema = T.StructType.fromJson(json.loads(entry["schema_json"]))
    ready = typed_for_store(df, lang).select(*[column(f.name) for f in schema.fields])
    part = _new_part(dataset_folder(opening.part))
    _laid_out(ready, entry["partitioning"], ()).write.partitionBy(*entry["partitioning"]).parquet(part)
    _append_part(spark, root, cube_id, lang, part, entry)
    return open_cube(spark, root, cube_id, lang)


def open_cube(spark: SparkSession, root: str, cube_id: str, language: str = "eng", as_of: datetime | None = None) -> DataFrame:
    """Lazy frame of a stored cube with the schema it was stored with, at present or as of an earlier time.

    Without the saved schema Spark would read a partition value such as ``01`` as a number.
    """
    lang = language_code(language)
    parts = _state(spark, root, cube_id, lang, as_of)
    schema = T.StructType.fromJson(json.loads(parts[-1].entry.schema_json))
    layouts: dict[str, list[str]] = {}
    for r in parts:
        # A part that a refresh has thinned out is read by its pieces.
        layouts.setdefault(dataset_folder(r.part), []).extend([r.part] if r.pieces is None else r.pieces)
    return _frame(spark, schema, layouts)


def _frame(spark: SparkSession, schema: T.StructType, layouts: dict[str, list[str]]) -> DataFrame:
    """Rows below some paths of each dataset folder."""
    frames = []
    for folder, paths in layouts.items():
        if paths:
            stored = spark.read.schema(schema).option("basePath", folder).parquet(*paths)
            frames.append(stored.select(*[column(f.name) for f in schema.fields]))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def _digests(rows: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Number of rows and two sums of row hashes per partition value: equal for equal rows in any order."""
    flagged = [x for c in columns for x in (column(c), column(c).isNull())]
    first, second = F.xxhash64(F.lit(1), *flagged), F.xxhash64(F.lit(2), *flagged)
    return rows.groupBy(*[column(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(first.cast("decimal(38,0)")).alias("__first"),
        F.sum(second.cast("decimal(38,0)")).alias("__second"),
    )


def refresh_cube(df: DataFrame, root: str, cube_id: str, language: str = "eng") -> list[str]:
    """Bring a stored cube to the rows of ``df`` and write only the partitions that differ; returns the commit's id, or nothing if none differs.

    Stored and new rows are reduced to digests per combination of partition values. Rows of combinations that differ form
    a new part, the pieces that held them before are removed, all others stay as they are. A cube without partitions is one combination.
    """
    spark, lang = df.sparkSession, language_code(language)
    with _replacing(spark, root, cube_id, lang) as commit:
        parts = _state(spark, root, cube_id, lang)
        entry = parts[-1].entry
        schema = T.StructType.fromJson(json.loads(entry.schema_json))
        names, keys = [f.name for f in schema.fields], list(entry.partitioning)
        new = materialize(typed_for_store(df, lang).select(*[column(c) for c in names]), "refreshed")
        # Texts of the keys, so that a missing value is a key like any other.
        whole = F.to_json(F.struct(F.lit(0).alias("__"), *[column(k) for k in keys]), {"ignoreNullFields": "false"})
        stored = open_cube(spark, root, cube_id, lang).withColumn("__key", whole)
        fresh = new.withColumn("__key", whole)
        old_digest = _digests(stored, names, ["__key"])
        new_digest = _digests(fresh, names, ["__key"]).toDF("__key", "__n2", "__first2", "__second2")
        both = old_digest.join(new_digest, "__key", "full")
        same = F.col("__n").eqNullSafe(F.col("__n2")) & F.col("__first").eqNullSafe(F.col("__first2")) & F.col("__second").eqNullSafe(F.col("__second2"))
        changed = materialize(both.filter(~same).select("__key"), "changed")
        if changed.isEmpty():
            return []
        part = _new_part(dataset_folder(parts[-1].part))
        rows = lookup_join(fresh, changed, ["__key"], "left_semi").select(*[column(c) for c in names])
        _laid_out(rows, keys, ()).write.partitionBy(*keys).parquet(part)
        # The folders in which stored rows of those combinations lie; one row per combination and part.
        held = lookup_join(_with_folder(spark, parts, schema).withColumn("__key", whole), changed, ["__key"], "left_semi").select("__folder").distinct()
        uris = {r["__folder"] for r in held.collect()}
        pieces = _log_of(spark, root, cube_id, lang).filter("action = 'piece'").select("part", "piece", "piece_uri").distinct()
        current = {r.part for r in parts}
        removed = [(r.part, r.piece) for r in pieces.collect() if r.piece_uri in uris and r.part in current]
        _replace(spark, root, cube_id, lang, commit, part, removed, keys, entry.schema_json, entry.title)
    return [commit]


def _with_folder(spark: SparkSession, parts: list, schema: T.StructType) -> DataFrame:
    """Rows of the parts with the folder that each lies in."""
    frames = []
    for folder in sorted({dataset_folder(r.part) for r in parts}):
        paths = [p for r in parts if dataset_folder(r.part) == folder for p in ([r.part] if r.pieces is None else r.pieces)]
        if paths:
            stored = spark.read.schema(schema).option("basePath", folder).parquet(*paths)
            frames.append(stored.select(*[column(f.name) for f in schema.fields], _folder_of(F.col("_metadata.file_path")).alias("__folder")))
    empty = T.StructType([*schema.fields, T.StructField("__folder", T.StringType())])
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], empty)


def open_current(
    spark: SparkSession,
    root: str,
    cube_id: str,
    load: Callable[[], DataFrame],
    language: str = "eng",
    refresh: bool | str = False,
    released: datetime | None = None,
    **options,
) -> DataFrame:
    """Open a stored cube; store it first if it is absent, or refresh it if it has to be.

    ``refresh`` True always compares it with the new rows, ``"auto"`` if it was ``released`` after it was
    stored; otherwise an outdated copy only raises a warning. ``load`` gives the new rows. Where they have the columns and the partitioning that the stored
    cube has, only the partitions that differ are written; else the cube is stored anew.
    """
    lang = language_code(language)
    stored = registry_entries(spark, root).filter(
        (F.col(CUBE_ID) == cube_id) & (F.col("language") == lang)
    )
    released_at = F.lit(released).cast("timestamp")
    outdated = F.coalesce(F.col("time_cached") < released_at, F.lit(False))
    entry = stored.withColumn("outdated", outdated).first()
    if entry is None:
        return store_cube(load(), root, cube_id, lang, **options)
    if not (refresh is True or (refresh == "auto" and entry.outdated)):
        if entry.outdated:
            warnings.warn(f"Stored cube {cube_id} is out of date, it was released again {released}.")
        return open_cube(spark, root, cube_id, lang)
    rows = load()
    typed = typed_for_store(rows, lang) if options.get("typed", True) else rows
    kept_schema = T.StructType.fromJson(json.loads(entry.schema_json))
    alike = [(f.name, f.dataType) for f in typed.schema.fields] == [(f.name, f.dataType) for f in kept_schema.fields]
    if alike and same_columns(entry.partitioning, list(options.get("partition_by", entry.partitioning))):
        if not refresh_cube(rows, root, cube_id, lang):
            _touch(spark, root, cube_id, lang)
        return open_cube(spark, root, cube_id, lang)
    return store_cube(rows, root, cube_id, lang, **options)


def _touch(spark: SparkSession, root: str, cube_id: str, language: str) -> None:
    """Note that a cube was found equal to a new release: its description again, at the present time, and no file."""
    opening = _opening(spark, root, cube_id, language)
    entry = opening.entry.asDict()
    row = {CUBE_ID: cube_id, "language": language, "commit": uuid.uuid4().hex, "action": "appended", "part": opening.part, "time_cached": datetime.now(timezone.utc)}
    _commit(spark, f"{_cube_log(root, cube_id, language)}/appended", _rows(spark, [{**row, **{k: entry[k] for k in _ENTRY}}]), row["commit"])


def repartition_cube(
    spark: SparkSession,
    root: str,
    cube_id: str,
    partition_by: Sequence[str],
    language: str = "eng",
    cluster_by: Sequence[str] = (),
) -> bool:
    """Rewrite a stored cube under another partitioning; False if it already has it."""
    lang = language_code(language)
    entry = _opening(spark, root, cube_id, lang).entry
    if same_columns(entry.partitioning, list(partition_by)):
        return False
    _rewrite(spark, root, cube_id, lang, partition_by, cluster_by)
    return True


def compact_cube(spark: SparkSession, root: str, cube_id: str, language: str = "eng", cluster_by: Sequence[str] = ()) -> None:
    """Write the parts of a cube into one, under the same partitioning."""
    lang = language_code(language)
    _rewrite(spark, root, cube_id, lang, _opening(spark, root, cube_id, lang).entry.partitioning, cluster_by)


def _rewrite(spark: SparkSession, root: str, cube_id: str, language: str, partition_by: Sequence[str], cluster_by: Sequence[str]) -> None:
    with _replacing(spark, root, cube_id, language) as commit:
        # One reading of the log decides what is rewritten and what is removed.
        parts = _state(spark, root, cube_id, language)
        rows = _with_folder(spark, parts, T.StructType.fromJson(json.loads(parts[-1].entry.schema_json))).drop("__folder")
        absent = [c for c in [*partition_by, *cluster_by] if c not in rows.columns]
        if absent:
            raise ValueError(f"The cube lacks columns to partition or sort by: {absent}")
        part = _new_part(_new_dataset(root, cube_id, language))
        _laid_out(rows, partition_by, cluster_by).write.partitionBy(*partition_by).parquet(part)
        removed = [(r.part, None) for r in parts]
        _replace(spark, root, cube_id, language, commit, part, removed, partition_by, parts[-1].entry.schema_json, parts[-1].entry.title)


def release_versions(spark: SparkSession, root: str, before: datetime | None = None) -> int:
    """Delete the files of parts and pieces that were removed before a time (by default: until now); returns how many.

    Versions that use them can't be read any more, so the time is that of the oldest version that readers may still hold.
    """
    log = _log(spark, _registry_path(root))
    key = [CUBE_ID, "language", "part", "piece"]
    gone = log.filter(F.col("action").isin("removed", "released")).groupBy(*key).agg(
        F.min(F.when(F.col("action") == "removed", F.col("time_cached"))).alias("removed"), F.max(F.col("action") == "released").alias("released")
    )
    limit = before or datetime.now(timezone.utc)
    due = materialize(gone.filter(~F.col("released") & (F.col("removed") <= F.lit(limit))).select(*key), "due")
    released = 0
    for r in due.select("part", "piece").toLocalIterator():
        _remove_folder(spark, root, r.piece or r.part)
        released += 1
    if released:
        commit = uuid.uuid4().hex
        fields = T.StructType.fromDDL(LOG_SCHEMA).fields
        given = {**{k: F.col(k) for k in key}, "commit": F.lit(commit), "action": F.lit("released"), "time_cached": F.lit(datetime.now(timezone.utc))}
        rows = due.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        _commit(spark, f"{_registry_path(root)}/dropped", rows, commit)
    return released


def cube_registry(spark: SparkSession, root: str, catalog: DataFrame | None = None) -> DataFrame:
    """Stored cubes with size and, given a catalog, their release time and freshness."""
    listed = registry_entries(spark, root)
    listed = listed.select(
        CUBE_ID,
        "language",
        "format",
        "time_cached",
        X.readable_size(F.col("bytes")).alias("size"),
        "bytes",
        "title",
        "partitioning",
    )
    return with_freshness(listed, catalog) if catalog is not None else listed


def with_freshness(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    """Left join the catalog: ``time_released`` and whether the stored copy is newer."""
    released = catalog.select(CUBE_ID, F.col("releaseTime").alias("time_released"))
    return registry.join(released, CUBE_ID, "left").withColumn(
        "up_to_date", F.col("time_released") < F.col("time_cached")
    )


def stale_cubes(registry: DataFrame, releases: DataFrame) -> DataFrame:
    """Stored cubes that were released again after they were stored (``last_release`` per cube)."""
    return registry.join(releases.select(CUBE_ID, "last_release"), CUBE_ID).filter(
        F.col("time_cached") < F.col("last_release")
    )


def select_entries(
    registry: DataFrame,
    cubes: Iterable[str] | DataFrame,
    languages: Iterable[str] = ("eng", "fra"),
    formats: Iterable[str] = (FORMAT,),
) -> DataFrame:
    """Registry rows by ids, or by inner join with a (filtered) registry frame."""
    if isinstance(cubes, DataFrame):
        key = [CUBE_ID, "language", "format"]
        return registry.join(cubes.select(*key).distinct(), key)
    return registry.filter(
        F.col(CUBE_ID).isin(list(cubes))
        & F.col("language").isin([language_code(x) for x in languages])
        & F.col("format").isin(list(formats))
    )


def drop_cubes(
    spark: SparkSession,
    root: str,
    cubes: Iterable[str] | DataFrame,
    languages: Iterable[str] = ("eng", "fra"),
) -> int:
    """Drop stored cubes, by ids or by a (filtered) registry frame; returns how many.

    All are dropped by one commit. Frames that were opened before can still be read, until ``release_versions``.
    """
    chosen = select_entries(registry_entries(spark, root), cubes, languages).select(CUBE_ID, "language").distinct()
    parts = _parts(_log(spark, _registry_path(root))).select(CUBE_ID, "language", "part")
    dropped = materialize(parts.join(chosen, [CUBE_ID, "language"], "left_semi"), "dropped")
    count = dropped.select(CUBE_ID, "language").distinct().count()
    if count:
        commit = uuid.uuid4().hex
        given = {CUBE_ID: F.col(CUBE_ID), "language": F.col("language"), "part": F.col("part"), "commit": F.lit(commit), "action": F.lit("removed"),
                 "time_cached": F.lit(datetime.now(timezone.utc))}
        rows = dropped.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(LOG_SCHEMA).fields])
        _commit(spark, f"{_registry_path(root)}/dropped", rows, commit)
    return count
