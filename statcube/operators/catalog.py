"""Catalog of cubes: projections, search, code labels, notes, releases and freshness."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.functions import expressions as X
from statcube.functions.names import CUBE_ID, column, names_for
from statcube.operators.joins import lookup_join
from statcube.sources.scratch import materialize

SEARCHED = (
    "cubeTitleEn",
    "cubeTitleFr",
    "surveyEn",
    "surveyFr",
    "subjectEn",
    "subjectFr",
    "subjectCode",
    "surveyCode",
    CUBE_ID,
    "productId",
)
PUBLISHING_TIME = time(9, 0)
# A map is searched from its beginning, so it has to be short.
MAPPED_CODES = 2000


def search_catalog(catalog: DataFrame, term: str) -> DataFrame:
    """Cubes where any searched field matches the regular expression, in any letter case."""
    hit = F.lit(False)
    for field in SEARCHED:
        if field in catalog.columns:
            hit = hit | F.coalesce(column(field).rlike("(?i)" + term), F.lit(False))
    return catalog.filter(hit)


def label_codes(
    df: DataFrame, key: str, codes: str, code_set: DataFrame, code: str, labels: dict[str, str]
) -> DataFrame:
    """Turn a ``", "`` list of codes into ``"; "`` lists of labels, order kept.

    ``labels`` maps a label column of the code set to the new column. Codes that are not in the
    set are left out. A code set of up to ``MAPPED_CODES`` rows becomes a map in the projection of the rows, without
    any shuffle of these. With a larger set, or one that repeats codes, the list of a row is taken apart and put together by the row's key.
    """
    code_set = materialize(
        code_set.select(column(code).cast("string").alias(code), *[column(c) for c in labels]).filter(column(code).isNotNull()), "codes"
    )
    rows, distinct = code_set.agg(F.count(F.lit(1)), F.count_distinct(column(code))).first()
    if 0 < rows <= MAPPED_CODES and rows == distinct:
        known_codes = code_set.collect()  # at most MAPPED_CODES rows

        def mapped(label: str) -> Column:
            by_code = X.literal_map({r[code]: r[label] for r in known_codes})
            found = F.transform(F.split(column(codes), ", "), lambda c: F.try_element_at(by_code, c))
            return F.coalesce(F.array_join(found, "; "), F.lit(""))

        return df.withColumns({name: mapped(label) for label, name in labels.items()})
    exploded = df.select(column(key), F.posexplode(F.split(column(codes), ", ")).alias("__pos", "__code"))
    lookup = code_set.select(
        column(code).cast("string").alias("__code"), *[column(c).alias(n) for c, n in labels.items()]
    )
    known = lookup_join(exploded, lookup, ["__code"], "inner")

    def joined(name: str):
        texts = F.array_sort(F.collect_list(F.struct("__pos", column(name).alias("label"))))
        return F.array_join(F.transform(texts, lambda s: s["label"]), "; ").alias(name)

    labelled = known.groupBy(key).agg(*[joined(n) for n in labels.values()])
    result = df.join(labelled, key, "left")
    return result.select(
        *[column(c) for c in df.columns],
        *[F.coalesce(column(n), F.lit("")).alias(n) for n in labels.values()],
    )


def label_catalog(catalog: DataFrame, surveys: DataFrame, subjects: DataFrame) -> DataFrame:
    """Survey and subject names in both languages next to the code lists."""
    with_surveys = label_codes(
        catalog, CUBE_ID, "surveyCode", surveys, "surveyCode", {"surveyEn": "surveyEn", "surveyFr": "surveyFr"}
    )
    return label_codes(
        with_surveys,
        CUBE_ID,
        "subjectCode",
        subjects,
        "subjectCode",
        {"subjectEn": "subjectEn", "subjectFr": "subjectFr"},
    )


def cube_info(overview: DataFrame, language: str = "eng") -> DataFrame:
    """Title, ids, archive status, frequency and reference periods under published headings."""
    n = names_for(language)
    suffix = "Fr" if n.language == "fra" else "En"
    kept = {
        f"cubeTitle{suffix}": n.cube_title,
        "productId": "Product Id",
        "legacyId": "Legacy Id",
        f"archiveStatus{suffix}": "Archive Status",
        "frequencyCode": n.frequency,
        "cubeStartDate": n.start_period,
        "cubeEndDate": n.end_period,
    }
    return overview.select(*[column(a).alias(b) for a, b in kept.items() if a in overview.columns])


def cube_surveys(overview: DataFrame, language: str = "eng") -> DataFrame:
    return overview.select(F.col("surveyCode").alias(names_for(language).survey_code))


def cube_subjects(overview: DataFrame, language: str = "eng") -> DataFrame:
    """One row per subject code."""
    return overview.select(
        F.explode(F.split("subjectCode", ", ")).alias(names_for(language).subject_code)
    )


def short_notes(notes: DataFrame, language: str = "eng") -> DataFrame:
    """Distinct notes of a cube, without their links."""
    n = names_for(language)
    text = "footnotesFr" if n.language == "fra" else "footnotesEn"
    return notes.select(F.col("footnoteId").alias(n.note_id), F.col(text).alias("Note")).distinct()


def notes_with_members(notes: DataFrame, members: DataFrame, language: str = "eng") -> DataFrame:
    """Notes with the names of the dimension and member they are linked to, if any."""
    n = names_for(language)
    text = "footnotesFr" if n.language == "fra" else "footnotesEn"
    link = ["dimensionPositionId", "memberId"]
    names = members.select(
        F.col("dim_id").cast("string").alias(link[0]),
        F.col("member_id").alias(link[1]),
        F.col("dim_name").alias(n.dimension_name),
        F.col("member_name").alias(n.member_name),
    ).distinct()
    keyed = notes.select(
        F.col("footnoteId").alias(n.note_id),
        F.col(text).alias("Note"),
        *[F.col(c).cast("string").alias(c) for c in link],
    )
    return lookup_join(keyed, names, link).select(
        column(n.note_id), "Note", column(n.dimension_name), column(n.member_name)
    )


def notes_by_reference(
    dimensions: DataFrame, members: DataFrame, notes: DataFrame, language: str = "eng"
) -> DataFrame:
    """Every reference of a dimension or member to a note, in full outer join with the texts.

    ``note_ids`` of dimensions and members is a ``;`` list; the result is in note order.
    """
    n = names_for(language)
    references = dimensions.select("dim_name", "note_ids").unionByName(
        members.select("dim_name", "member_name", "note_ids"), allowMissingColumns=True
    )
    exploded = references.filter(F.col("note_ids").isNotNull()).select(
        F.col("dim_name").alias(n.dimension_name),
        F.col("member_name").alias(n.member_name),
        F.explode(F.split("note_ids", ";")).alias(n.note_id),
    )
    texts = notes.select(F.col("note_id").cast("string").alias(n.note_id), F.col("note").alias("Note"))
    # A full outer join in two parts: one note may be referred to by very many members, and only
    # a left join can be spread over tasks.
    used = exploded.select(column(n.note_id)).distinct()
    joined = lookup_join(exploded, texts, [n.note_id]).unionByName(
        texts.join(used, n.note_id, "left_anti"), allowMissingColumns=True
    )
    order = [column(n.note_id).try_cast("bigint").asc_nulls_last(), column(n.dimension_name), column(n.member_name)]
    return joined.select(
        column(n.dimension_name), column(n.member_name), column(n.note_id), "Note"
    ).orderBy(*order)


def map_legacy_ids(
    df: DataFrame, correspondence: DataFrame, legacy: str
) -> tuple[DataFrame, DataFrame]:
    """Current cube id of old-style ids, and the rows that have none.

    ``correspondence`` holds ``legacy_id`` and ``product_id`` as integers.
    """
    table = correspondence.select(
        F.col("legacy_id").cast("bigint").alias("__legacy"),
        X.clean_cube_id(F.col("product_id").cast("string")).alias(CUBE_ID),
    )
    number = F.regexp_replace(column(legacy).cast("string"), "-", "").try_cast("bigint")
    joined = lookup_join(df.withColumn("__legacy", number), table, ["__legacy"]).drop("__legacy")
    matched = joined.filter(F.col(CUBE_ID).isNotNull())
    return matched, joined.filter(F.col(CUBE_ID).isNull()).drop(CUBE_ID)


def last_release(releases: DataFrame, cubes: DataFrame | None = None) -> DataFrame:
    """Latest release of every cube; with a frame of cubes, NULL for those never released."""
    latest = releases.groupBy(CUBE_ID).agg(F.max("releaseTime").alias("last_release"))
    return latest if cubes is None else cubes.select(CUBE_ID).distinct().join(latest, CUBE_ID, "left")


def last_available_date(now: datetime) -> date:
    """Today, or yesterday before 09:00 publisher time."""
    local = now.astimezone(ZoneInfo(X.PUBLISHER_ZONE))
    return local.date() if local.time() >= PUBLISHING_TIME else local.date() - timedelta(days=1)


def changed_cubes(
    releases: DataFrame, start: date, end: date | None = None, now: datetime | None = None
) -> DataFrame:
    """Releases between two dates (both included, in either order).

    Days are the publisher's: of a release time that is an instant, the days begin at midnight of the publisher's zone.

    A start after the last available date is rejected, an end after it is capped.
    """
    limit = last_available_date(now or datetime.now(ZoneInfo(X.PUBLISHER_ZONE)))
    if start > limit:
        raise ValueError(f"Nothing is published after {limit}; the start {start} is later")
    until = min(end or start, limit)
    first, last = min(start, until), max(start, until)
    kind = dict(releases.dtypes)["releaseTime"]
    # Bounds on the raw column, so that they reach the scan.
    zone = f" 00:00:00 {X.PUBLISHER_ZONE}" if kind == "timestamp" else ""
    from_time = F.lit(first.isoformat() + zone).cast(kind)
    to_time = F.lit((last + timedelta(days=1)).isoformat() + zone).cast(kind)
    return releases.filter((F.col("releaseTime") >= from_time) & (F.col("releaseTime") < to_time))
