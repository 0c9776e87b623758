"""Entry points that combine the operators: normalize, load, and series requests.

All of them return lazy frames. Filters written after them still reach the scan, because the
enrichment joins keep the facts on the streamed side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import (
    DATE,
    canonical_order,
    column,
    language_of,
    names_for,
    rename_language,
)
from statcube.operators.enrich import (
    CubeMetadata,
    attach_member_names,
    describe_cube,
    fold_in_categories,
    fold_in_metadata,
    strip_codes,
)
from statcube.operators.reshape import wide_to_long
from statcube.operators.series import (
    latest_n,
    missing_series,
    release_range,
    request_frame,
    select_coordinates,
    select_vectors,
    series_range,
)
from statcube.plans.metadata import open_metadata
from statcube.sources.delimited import read_cube_csv
from statcube.sources.metadata_text import cube_members_of, parse_cube_metadata
from statcube.sources.store import add_geo_uid, open_cube


def normalize_values(
    df: DataFrame,
    language: str | None = None,
    replacement: str | None = "val_norm",
    normalize_percent: bool = True,
    default_month: str = "01",
    default_day: str = "01",
) -> DataFrame:
    """Scale values to units, turn percentages into rates, parse reference periods.

    ``replacement`` None overwrites the value and drops the scale columns. Cubes without a scale
    column get neither a scaled value nor a date.
    """
    n = names_for(language or language_of(df))
    target = replacement or n.value
    result = df
    has_scale = n.scalar_id in df.columns
    if has_scale:
        result = result.withColumn(target, X.scaled(column(n.value), column(n.scalar_id)))
    if replacement is None:
        result = result.drop(*[c for c in (n.scalar_id, n.scalar_factor) if c in result.columns])
    if normalize_percent and n.uom in result.columns and target in result.columns:
        result = result.withColumn(
            target, X.percent_to_rate(column(target), column(n.uom), n.language)
        )
    if has_scale and n.ref_date in result.columns:
        result = result.withColumn(
            DATE, X.reference_date(column(n.ref_date), default_month, default_day)
        )
    return result


def normalize_cube(
    df: DataFrame,
    meta: CubeMetadata | None = None,
    replacement: str | None = "val_norm",
    normalize_percent: bool = True,
    default_month: str = "01",
    default_day: str = "01",
    categories: bool = True,
    strip_classification_code: bool = False,
) -> DataFrame:
    """Values, dates, member metadata, clean labels and canonical column order.

    ``categories`` also strips codes, replaces ambiguous names and adds ``<column>__ord``.
    """
    language = meta.language if meta else language_of(df)
    result = normalize_values(
        df, language, replacement, normalize_percent, default_month, default_day
    )
    if meta is not None and categories:
        result = fold_in_categories(result, meta)
    elif meta is not None:
        result = fold_in_metadata(result, meta)
        if strip_classification_code:
            result = strip_codes(result, meta)
    return canonical_order(result, language)


def load_cube(
    spark: SparkSession,
    data_path: str,
    metadata_path: str,
    cube_id: str,
    language: str = "eng",
    categories: bool = True,
    default_month: str = "07",
    default_day: str = "01",
) -> DataFrame:
    """A whole cube from its landed extract and metadata file."""
    raw = add_geo_uid(wide_to_long(read_cube_csv(spark, data_path, language), language))
    members = cube_members_of(parse_cube_metadata(spark, metadata_path, language), cube_id)
    meta = describe_cube(members, cube_id, names_for(language).language)
    return normalize_cube(
        raw, meta, categories=categories, default_month=default_month, default_day=default_day
    )


def query_stored_cube(
    spark: SparkSession,
    root: str,
    cube_id: str,
    condition,
    meta: CubeMetadata | None = None,
    language: str = "eng",
    **options,
) -> DataFrame:
    """Filter a stored cube and normalize what is left, by the stored metadata if none is given."""
    meta = meta or open_metadata(spark, root, cube_id, language)
    options = {"default_month": "07", "default_day": "01", **options}
    stored = open_cube(spark, root, cube_id, meta.language).filter(condition)
    return normalize_cube(wide_to_long(stored, meta.language), meta, **options)


def finish_series(
    observations: DataFrame,
    members: DataFrame,
    language: str = "eng",
    default_month: str = "07",
    default_day: str = "01",
    categories: bool = True,
) -> DataFrame:
    """Names by coordinate, language, values and dates for rows of selected series."""
    n = names_for(language)
    rows = observations if n.language == "eng" else rename_language(observations, "eng", language)
    named = attach_member_names(rows, members, language, categories)
    normal = normalize_values(
        named, n.language, default_month=default_month, default_day=default_day
    )
    stripped = normal.withColumn(n.coordinate, X.strip_coordinate(column(n.coordinate)))
    return canonical_order(stripped, n.language)


def series_by_vector(
    observations: DataFrame,
    members: DataFrame,
    vectors: Iterable[str | int] | Mapping[str, str] | DataFrame,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    use_ref_date: bool = True,
    language: str = "eng",
    **options,
) -> DataFrame:
    """Series by vector in a range of reference periods or of release times."""
    chosen = select_vectors(observations, vectors)
    if use_ref_date:
        chosen = series_range(chosen, start, end)
    else:
        chosen = release_range(chosen, start, end)
    return finish_series(chosen, members, language, **options)


def latest_series(
    observations: DataFrame,
    members: DataFrame,
    vectors: Iterable[str | int] | Mapping[str, str] | DataFrame,
    periods: int | None = None,
    language: str = "eng",
    **options,
) -> DataFrame:
    """The last periods with data of each vector."""
    chosen = latest_n(select_vectors(observations, vectors), periods)
    return finish_series(chosen, members, language, **options)


def series_by_coordinate(
    observations: DataFrame,
    members: DataFrame,
    requests: Mapping[str, Sequence[str]] | DataFrame,
    periods: int | None = None,
    language: str = "eng",
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Series of (cube, coordinate) requests or a template, and the requests without an answer."""
    wanted = requests if isinstance(requests, DataFrame) else request_frame(
        observations.sparkSession, requests
    )
    if periods is not None and "periods" not in wanted.columns:
        wanted = wanted.withColumn("periods", F.lit(periods))
    chosen = select_coordinates(observations, wanted)
    return finish_series(chosen, members, language, **options), missing_series(observations, wanted)
