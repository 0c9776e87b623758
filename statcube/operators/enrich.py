"""Member metadata on the facts: fold-in, names by coordinate, abbreviations, category order."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import (
    CUBE_ID,
    GEO_UID,
    column,
    data_column,
    language_of,
    names_for,
)
from statcube.operators.joins import fits_broadcast, lookup_join, number_rows
from statcube.operators.members import build_hierarchy, category_levels, dedupe_members, member_order
from statcube.sources.scratch import materialize, materialize_measured

ORDER_SUFFIX = "__ord"
_MEMBER = "__member"

# --- fixed values: abbreviations of provinces, in display order --------------------------------
ABBREVIATION_ORDER = (
    "CAN", "BC", "AB", "SK", "MB", "ON", "QC", "NB", "PE", "NS", "NL", "YT", "NT", "NU", "NTNU",
)
PROVINCES = {
    "eng": {
        "British Columbia": "BC",
        "Alberta": "AB",
        "Saskatchewan": "SK",
        "Manitoba": "MB",
        "Ontario": "ON",
        "Quebec": "QC",
        "New Brunswick": "NB",
        "Prince Edward Island": "PE",
        "Nova Scotia": "NS",
        "Newfoundland and Labrador": "NL",
        "Yukon": "YT",
        "Northwest Territories": "NT",
        "Nunavut": "NU",
        "Northwest Territories including Nunavut": "NTNU",
        "Canada": "CAN",
    },
    "fra": {
        "Colombie-Britannique": "BC",
        "Alberta": "AB",
        "Saskatchewan": "SK",
        "Manitoba": "MB",
        "Ontario": "ON",
        "Québec": "QC",
        "Nouveau-Brunswick": "NB",
        "Île-du-Prince-Édouard": "PE",
        "Nouvelle-Écosse": "NS",
        "Terre-Neuve-et-Labrador": "NL",
        "Yukon": "YT",
        "Territoires du Nord-Ouest": "NT",
        "Nunavut": "NU",
        "Territoires du Nord-Ouest incluant Nunavut": "NTNU",
        "Canada": "CAN",
    },
}
# --- end of fixed values -----------------------------------------------------------------------


@dataclass(frozen=True)
class Dimension:
    """Facts about one dimension that decide how the plan looks."""

    position: int
    name: str
    has_codes: bool
    renamed: bool
    unique: bool


@dataclass(frozen=True)
class CubeMetadata:
    """Members of one cube, written once, and what is known about its dimensions."""

    cube_id: str
    language: str
    members: DataFrame
    dimensions: tuple[Dimension, ...]
    bounded: bool

    def dimension(self, name: str) -> Dimension | None:
        return next((d for d in self.dimensions if d.name == name), None)


def prepare_members(members: DataFrame, broadcast_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Members of any number of cubes with paths, unambiguous names and order, as a written table.

    Also tells whether they are few enough to be broadcast.
    """
    own, size = materialize_measured(members, "members")
    small = fits_broadcast(size, broadcast_rows)
    key = [CUBE_ID, "dim_id", "member_id"]
    levels = category_levels(dedupe_members(own, small), small).drop("member_name")
    return materialize(lookup_join(build_hierarchy(own, small), levels, key, bounded=small), "members"), small


def cube_metadata(ready: DataFrame, cube_id: str, language: str, bounded: bool) -> CubeMetadata:
    """Metadata of one cube from its prepared members."""
    rows = (
        ready.groupBy("dim_id", "dim_name")
        .agg(
            F.bool_or(F.col("code").isNotNull()).alias("has_codes"),
            F.bool_or(~F.col("original")).alias("renamed"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("level_name").alias("n_names"),
        )
        .orderBy("dim_id")
        .collect()  # one row per dimension, at most ten positions in a coordinate
    )
    dimensions = tuple(
        Dimension(int(r.dim_id), r.dim_name, r.has_codes, r.renamed, r.n == r.n_names) for r in rows
    )
    return CubeMetadata(cube_id, language, ready, dimensions, bounded)


def describe_cube(
    members: DataFrame, cube_id: str, language: str = "eng", broadcast_rows: int | None = None
) -> CubeMetadata:
    """Prepare the members of one cube; for many, and for use in later jobs, store them (``plans.metadata``)."""
    ready, small = prepare_members(members.filter(F.col(CUBE_ID) == cube_id), broadcast_rows)
    return cube_metadata(ready, cube_id, language, small)


def attach_by_coordinate(
    df: DataFrame, meta: CubeMetadata, wanted: dict[int, dict[str, str]]
) -> DataFrame:
    """Attach member columns (source name -> new name) per dimension position.

    Members of measured small size are broadcast, so the facts are not shuffled. A larger set
    is attached to the distinct coordinates first and the facts are joined once.
    """
    coordinate = names_for(meta.language).coordinate
    target = df if meta.bounded else df.select(column(coordinate)).distinct()
    for position, renames in wanted.items():
        if not renames:
            continue
        lookup = meta.members.filter(F.col("dim_id") == position).select(
            F.col("member_id").alias(_MEMBER), *[column(a).alias(b) for a, b in renames.items()]
        )
        keyed = target.withColumn(_MEMBER, X.coordinate_part(column(coordinate), position))
        target = lookup_join(keyed, lookup, [_MEMBER], bounded=meta.bounded).drop(_MEMBER)
    if meta.bounded:
        return target
    return lookup_join(df, materialize(target, "coordinates"), [coordinate])


def _metadata_targets(
    columns: list[str], meta: CubeMetadata, dimensions: list[str] | None
) -> dict[int, dict[str, str]]:
    """Metadata columns to attach per dimension position; those that exist are left out."""
    n = names_for(meta.language)
    wanted: dict[int, dict[str, str]] = {}
    for name in dimensions or [d.name for d in meta.dimensions]:
        dimension = meta.dimension(name)
        field = data_column(name, columns, meta.language)
        if dimension is None or field is None:
            warnings.warn(f"Dimension {name} is left out: the cube or its metadata lacks it")
            continue
        if field == name:
            targets = {"code": n.code_for(name), "hierarchy": n.hierarchy_for(name)}
        else:
            targets = {"code": GEO_UID, "hierarchy": n.hierarchy_for(n.geo)}
        wanted[dimension.position] = {a: b for a, b in targets.items() if b not in columns}
    return wanted


def _attach_metadata(
    df: DataFrame, meta: CubeMetadata, wanted: dict[int, dict[str, str]]
) -> DataFrame:
    result = attach_by_coordinate(df, meta, wanted)
    if GEO_UID not in df.columns and GEO_UID in result.columns:
        result = result.withColumn(GEO_UID, X.without_brackets(F.col(GEO_UID)))
    return result


def fold_in_metadata(
    df: DataFrame, meta: CubeMetadata, dimensions: list[str] | None = None
) -> DataFrame:
    """Classification code and hierarchy path of every member, found by coordinate position.

    For geography the code becomes ``GeoUID``. Columns that exist are kept; a dimension
    that is neither a column nor geography is skipped with a warning.
    """
    return _attach_metadata(df, meta, _metadata_targets(df.columns, meta, dimensions))


def strip_codes(df: DataFrame, meta: CubeMetadata) -> DataFrame:
    """Remove the trailing code from labels of dimensions that have any code."""
    coded = [d.name for d in meta.dimensions if d.has_codes and d.name in df.columns]
    return df.withColumns({c: X.strip_code(column(c)) for c in coded})


def order_categories(df: DataFrame, meta: CubeMetadata) -> DataFrame:
    """Replace ambiguous names, add ``<column>__ord``, and null values outside the categories.

    Dimensions whose names still clash are left as text with a warning.
    """
    return _with_categories(df, meta, {})


def fold_in_categories(df: DataFrame, meta: CubeMetadata) -> DataFrame:
    """Metadata and category order together, with one lookup by member id per dimension.

    Classification codes are stripped from the labels.
    """
    return _with_categories(strip_codes(df, meta), meta, _metadata_targets(df.columns, meta, None))


def _with_categories(
    df: DataFrame, meta: CubeMetadata, wanted: dict[int, dict[str, str]]
) -> DataFrame:
    columns = df.columns
    by_id = {position: dict(targets) for position, targets in wanted.items()}
    replaced: list[str] = []
    by_name: list[tuple[Dimension, str]] = []
    for d in meta.dimensions:
        field = data_column(d.name, columns, meta.language)
        if field is None:
            continue
        if not d.unique:
            warnings.warn(f"Inconsistent names of categories in column {field}, left as text.")
        if d.renamed:
            replaced.append(field)
            targets = by_id.setdefault(d.position, {})
            targets["level_name"] = field
            if d.unique:
                targets["ord"] = field + ORDER_SUFFIX
        elif d.unique:
            by_name.append((d, field))

    result = _attach_metadata(df.drop(*replaced), meta, by_id)
    for d, field in by_name:
        names = meta.members.filter(F.col("dim_id") == d.position).select(
            F.col("level_name").alias(field), F.col("ord").alias(field + ORDER_SUFFIX)
        )
        result = lookup_join(result, names, [field], bounded=meta.bounded)
        known = column(field + ORDER_SUFFIX).isNotNull()
        result = result.withColumn(field, F.when(known, column(field)))
    added = [c for c in result.columns if c not in columns]
    return result.select(*[column(c) for c in columns], *[column(c) for c in added])


def coordinate_names(
    members: DataFrame, language: str = "eng", bounded: bool | None = None
) -> DataFrame:
    """Column name and member label used when names are attached to bare coordinates.

    Repeated names in a dimension get `` (k)`` in member order; a geography in first position
    is called GEO/GÉO. ``ord`` is the place of the member among the categories.
    """
    n = names_for(language)
    name_key = [CUBE_ID, "dim_id", "member_name"]
    repeated = members.groupBy(*name_key).count().filter("count > 1").drop("count")
    numbered = number_rows(
        lookup_join(members, repeated, name_key, "left_semi", bounded=bounded),
        name_key,
        [member_order()],
        "k",
        bounded=bool(bounded),
    ).select(
        CUBE_ID,
        "dim_id",
        "member_id",
        F.concat("member_name", F.lit(" ("), F.col("k").cast("string"), F.lit(")")).alias("numbered"),
    )
    first_geography = (F.col("dim_id") == 1) & F.col("dim_name").isin(*n.geography_names)
    labelled = lookup_join(members, numbered, [CUBE_ID, "dim_id", "member_id"], bounded=bounded)
    return category_levels(labelled, bool(bounded)).select(
        CUBE_ID,
        "dim_id",
        F.when(first_geography, F.lit(n.geo)).otherwise(F.col("dim_name")).alias("field"),
        "member_id",
        F.coalesce("numbered", "member_name").alias("member_label"),
        "ord",
    )


def attach_member_names(
    df: DataFrame, members: DataFrame, language: str = "eng", categories: bool = False
) -> DataFrame:
    """Member-name columns for (cube, coordinate) rows of any cubes, one join per position whatever the number of cubes and names.

    Only dimensions of cubes that occur in the data give columns. A member that is not in the metadata leaves
    NULL, and of two dimensions of a cube with one name the first counts. ``categories`` adds ``<column>__ord``. If the members are too
    many to be broadcast, the distinct coordinates are named first and the data are joined once.
    """
    coordinate = names_for(language).coordinate
    at_hand = members.join(df.select(CUBE_ID).distinct(), CUBE_ID, "left_semi")
    own, size = materialize_measured(at_hand, "members")
    bounded = fits_broadcast(size)
    labels = materialize(coordinate_names(own, language, bounded), "labels")
    # One row per column of the result.
    fields = [r["field"] for r in labels.groupBy("field").agg(F.min("dim_id").alias("at")).orderBy("at", "field").collect()]
    positions = [int(r[0]) for r in labels.select("dim_id").distinct().orderBy("dim_id").collect()]
    attached = {"member_label": ""}
    if categories:
        attached["ord"] = ORDER_SUFFIX
    if not fields:
        return df

    named = df if bounded else df.select(CUBE_ID, column(coordinate)).distinct()
    for d in positions:
        lookup = labels.filter(F.col("dim_id") == d).select(CUBE_ID, F.col("member_id").alias(_MEMBER), F.struct("field", *attached).alias(f"__at_{d}"))
        keyed = named.withColumn(_MEMBER, X.coordinate_part(column(coordinate), d))
        named = lookup_join(keyed, lookup, [CUBE_ID, _MEMBER], bounded=bounded).drop(_MEMBER)
    slots = F.array(*[F.col(f"__at_{d}") for d in positions])
    # The first slot of a name counts; positions that a cube does not have are NULL.
    names = F.transform(slots, lambda e: F.coalesce(e["field"], F.lit("")))
    first = F.filter(slots, lambda e, i: e.isNotNull() & (F.array_position(names, e["field"]) == i + 1))
    by_name = F.map_from_entries(F.transform(first, lambda e: F.struct(e["field"], e)))
    named = named.withColumn("__names", by_name).drop(*[f"__at_{d}" for d in positions])
    if not bounded:
        key = F.struct(F.col(CUBE_ID), column(coordinate))
        named = lookup_join(df.withColumn("__key", key), named.select(key.alias("__key"), "__names"), ["__key"], bounded=False).drop("__key")
    given = [F.try_element_at("__names", F.lit(f))[source].alias(f + suffix) for source, suffix in attached.items() for f in fields]
    return named.select(*[column(c) for c in df.columns], *given)


def add_geo_abbreviation(df: DataFrame) -> DataFrame:
    """Add ``GEO.abb`` and its display order; places that are no province get NULL."""
    language = language_of(df)
    geo = column(names_for(language).geo)
    abbreviation = F.try_element_at(X.literal_map(PROVINCES[language]), geo)
    position = {abb: i for i, abb in enumerate(ABBREVIATION_ORDER, start=1)}
    return df.withColumns(
        {
            "GEO.abb": abbreviation,
            "GEO.abb" + ORDER_SUFFIX: F.try_element_at(X.literal_map(position), abbreviation),
        }
    )
